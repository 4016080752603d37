"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from twohop import Tuning, adamic_adar, common_neighbors, jaccard, link_scores
from twohop.operators import attach, edge_bag, endpoint_degrees, source_nodes, top_k, two_hop_pairs
from twohop.sinks import report_lines
from twohop.sources import bad_rows, parse_edges


@pytest.fixture()
def shuffled(spark):
    """Joins as at scale: nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def edge_file(spark, tmp_path):
    path = str(tmp_path / "edges")
    rows = [(i % 17, (i * 7) % 23) for i in range(400)]
    spark.createDataFrame(rows, "src bigint, dst bigint").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("measure", [common_neighbors, jaccard, adamic_adar, link_scores])
def test_no_cross_join_and_no_python(shuffled, edge_file, measure):
    plan = executed(measure(edge_file))
    final = plan.split("Initial Plan")[0]
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "BroadcastExchange"):
        assert unwanted not in plan
    # Both sides of the wedge join read one shuffle, and the edges are folded only once.
    assert "ReusedExchange" in final


def test_top_k_keeps_k_rows_per_task(shuffled, edge_file):
    assert "TakeOrderedAndProject" in executed(top_k(common_neighbors(edge_file), 5))


def test_unconnected_pairs_take_no_join_of_their_own(shuffled, edge_file):
    plan = executed(common_neighbors(edge_file)).split("Initial Plan")[0]
    assert "LeftAnti" not in plan and plan.count("SortMergeJoin") == 2


def test_a_hot_node_is_split_when_attributes_are_joined(shuffled):
    spark = shuffled
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 60_000, numPartitions=8).selectExpr("if(id % 3 = 0, -1, id) AS src", "id AS dst")
        bag = edge_bag(rows)
        joined = attach(bag, "src", source_nodes(bag), {"degree": "degree"}).where("degree > 1")
        plan = executed(joined)
        assert joined.count() == 20_000
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lines_are_split_once(spark, tmp_path):
    spark.createDataFrame([("1 2",), ("x",)], "value string").write.text(str(tmp_path / "lines"))
    lines = spark.read.text(str(tmp_path / "lines"))
    for parsed in (parse_edges(lines), parse_edges(lines, mode="permissive"), bad_rows(lines)):
        assert parsed._jdf.queryExecution().executedPlan().toString().count("split(") == 1


def test_report_has_no_window_over_all_rows(edge_file):
    assert "Window" not in executed(report_lines(common_neighbors(edge_file), 50))


def test_pairs_are_turned_after_adding_up(shuffled, edge_file):
    for found in (two_hop_pairs(edge_file, "ne"), endpoint_degrees(edge_file)):
        plan = executed(found).split("Initial Plan")[0]
        assert plan.index("Generate inline") < plan.index("functions=[sum(copies" if "sum(copies" in plan else "functions=[max(")


def test_a_graph_without_hubs_pays_for_none(shuffled, edge_file):
    """The join of the hubs' slices is left out at run time; with hubs both joins are there."""
    few = executed(two_hop_pairs(edge_file)).split("Initial Plan")[0]
    sliced = executed(two_hop_pairs(edge_file, tuning=Tuning(slice_rows=5))).split("Initial Plan")[0]
    assert "Generate explode" not in few and sliced.count("Generate explode") == 2
