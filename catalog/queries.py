"""The registered queries, one per operator or measure: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import graphs
from twohop import Tuning, adamic_adar, common_neighbors, jaccard, link_scores
from twohop.functions import adamic_adar_score, weight_parts
from twohop.operators import (
    candidate_semi,
    canonical_pairs,
    contract_report,
    degrees,
    distinct_pairs,
    endpoint_degrees,
    middle_weights,
    non_edges,
    pair_degree_sum,
    pair_parts,
    simple_graph,
    symmetrize,
    two_hop_pairs,
    wedges,
    with_label,
    written_bag,
)
from twohop.plans import pair_totals, with_degree_total
from twohop.sinks import report_lines
from twohop.sources import bad_rows, drop_comments, parse_edges

TOP = 100
# At test scale no node is a hub by the default; these sizes send the top-k queries through the hub phases.
SMALL_HUBS = Tuning(slice_rows=50, light_fan_out=24)


def co_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: the wedges are counted first, and their edges are read again as markers."""
    return written_bag(graphs.co_returned(spark, sf_dir))


def edge_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.lineitem_edges(spark, sf_dir)


def comment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_comments(graphs.event_lines(spark, sf_dir))


def edge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_edges(graphs.co_returned_lines(spark, sf_dir))


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_rows(graphs.event_lines(spark, sf_dir))


def ranked_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    reports = [
        report_lines(scores, TOP).select(F.lit(name).alias("measure"), "rank", "line")
        for name, scores in (
            ("common_neighbors", common_neighbors(edges, TOP)),
            ("jaccard", jaccard(edges, TOP)),
            ("adamic_adar", adamic_adar(edges, TOP)),
        )
    ]
    return reduce(DataFrame.union, reports)


def wedge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wedges(graphs.co_returned_bag(spark, sf_dir), "all")
    return found.groupBy("k").agg(
        F.sum("copies").alias("wedges"),
        F.sum(F.col("copies") * F.col("u")).alias("sum_u"),
        F.sum(F.col("copies") * F.col("u") * F.col("v")).alias("sum_uv"),
    )


def wedge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    return two_hop_pairs(edges, parts=pair_parts(edges))


def wedges_with_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    found = wedges(edges, groups=pair_parts(edges))
    return found.groupBy("k").agg(
        F.sum("copies").alias("wedges"), F.sum("u").alias("sum_u"), F.sum("v").alias("sum_v")
    )


def two_hop_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    ordered = two_hop_pairs(edges, "ne", parts=2 * pair_parts(edges))
    return ordered.groupBy(F.col("u").alias("node")).agg(
        F.count(F.lit(1)).alias("partners"), F.sum("instances").alias("instances"), F.sum("v").alias("sum_partners")
    )


def pair_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graphs.supply(spark, sf_dir).select(F.col("src").alias("u"), F.col("dst").alias("v"))
    return canonical_pairs(edges).groupBy("u", "v").agg(F.count(F.lit(1)).alias("edge_rows"))


def pair_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    return with_label(non_edges(distinct_pairs(wedges(edges, parts=pair_parts(edges))), edges))


def open_wedges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = written_bag(graphs.co_returned_bag(spark, sf_dir))
    return non_edges(wedges(edges, parts=pair_parts(edges)), edges).groupBy("k").agg(F.sum("copies").alias("open_wedges"))


def middle_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    found = wedges(edges, degree=True, groups=pair_parts(edges))
    return found.groupBy("k", "degree").agg(F.sum("copies").alias("wedges"))


def cn_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = pair_totals(co_returned(spark, sf_dir), end_degrees=True, reverse=True)
    return with_degree_total(pairs, exact_orientation=True).select("u", "v", "cn", "total")


def candidates_by_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    found = wedges(edges, degree=True, parts=2 * pair_parts(edges))  # each task adds up its pairs twice
    scored = found.groupBy("u", "v").agg(F.sum("degree").alias("degree_sum"))
    # The candidates ask for the sums too, so that they read the wedges from the same shuffle and not from one of their own.
    return candidate_semi(scored, non_edges(scored.where(F.col("degree_sum").isNotNull()), edges))


def cn_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_totals(graphs.co_returned_bag(spark, sf_dir)).select("u", "v", "cn")


def found_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = co_returned(spark, sf_dir)
    return distinct_pairs(wedges(edges, parts=pair_parts(edges)))


def aa_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    high, low = weight_parts(F.col("weight"))
    edges = co_returned(spark, sf_dir)
    found = wedges(edges, weight=True, parts=pair_parts(edges))
    sums = found.groupBy("u", "v").agg(
        F.sum(high * F.col("copies")).alias("high"), F.sum(low * F.col("copies")).alias("low")
    )
    return sums.select("u", "v", adamic_adar_score(F.col("high"), F.col("low")).alias("aa"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "edge_scan": edge_scan,
    "comment_filter": comment_filter,
    "edge_parse": edge_parse,
    "bad_rows": bad_lines,
    "ranked_report": ranked_report,
    "wedge_join": wedge_join,
    "wedge_pairs": wedge_pairs,
    "wedges_with_middle": wedges_with_middle,
    "two_hop_ordered": two_hop_ordered,
    "pair_canonical": pair_canonical,
    "pair_label": pair_label,
    "non_edges": open_wedges,
    "endpoint_degrees": lambda spark, d: endpoint_degrees(co_returned(spark, d)),
    "middle_degrees": middle_degrees,
    "cn_with_total": cn_with_total,
    "candidate_semi": candidates_by_semi_join,
    "node_degree": lambda spark, d: degrees(graphs.co_returned_bag(spark, d)),
    "cn_count": cn_count,
    "pair_degree_sum": lambda spark, d: pair_degree_sum(endpoint_degrees(co_returned(spark, d), by_pair=True)),
    "shared_degree_list": lambda spark, d: middle_weights(co_returned(spark, d)),
    "aa_sum": aa_sum,
    "distinct_pairs": found_pairs,
    "top_k_cn": lambda spark, d: common_neighbors(graphs.co_returned(spark, d), TOP, tuning=SMALL_HUBS),
    "top_k_jc": lambda spark, d: jaccard(graphs.co_returned(spark, d), TOP, tuning=SMALL_HUBS),
    "top_k_aa": lambda spark, d: adamic_adar(graphs.co_returned(spark, d), TOP, tuning=SMALL_HUBS),
    "common_neighbors": lambda spark, d: common_neighbors(graphs.co_returned(spark, d)),
    "jaccard": lambda spark, d: jaccard(co_returned(spark, d), exact_orientation=False),
    "top_k_jaccard_as_is": lambda spark, d: jaccard(graphs.supply(spark, d), TOP, tuning=SMALL_HUBS),
    "jaccard_as_is": lambda spark, d: jaccard(graphs.supply(spark, d)),
    "adamic_adar": lambda spark, d: adamic_adar(co_returned(spark, d)),
    "link_scores": lambda spark, d: link_scores(co_returned(spark, d)),
    "symmetrize": lambda spark, d: symmetrize(graphs.supply(spark, d)),
    "simple_graph": lambda spark, d: simple_graph(graphs.supply(spark, d)),
    "contract_report": lambda spark, d: contract_report(graphs.supply(spark, d)),
}
