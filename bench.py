"""Time the headline queries and print one JSON line.

The graph is derived from the tables and written as a Parquet edge table once, before timing; each
query then starts from that file. One warm-up, then the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from catalog import graphs  # noqa: E402
from twohop import adamic_adar, common_neighbors, jaccard, link_scores, read_edge_table  # noqa: E402
from twohop.operators import wedges  # noqa: E402
from twohop.store import scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HUB = int(os.environ.get("BENCH_HUB", "10000"))
TOP = 100


def _sum_all(scores: DataFrame) -> None:
    """Compute every row and column without sending the rows to the driver."""
    scores.agg(F.count(F.lit(1)), *[F.sum(c) for c in scores.columns]).collect()


QUERIES = {
    "common_neighbors": lambda edges: _sum_all(common_neighbors(edges)),
    "jaccard": lambda edges: _sum_all(jaccard(edges)),
    "adamic_adar": lambda edges: _sum_all(adamic_adar(edges)),
    "link_scores": lambda edges: _sum_all(link_scores(edges)),
    "top_k_cn": lambda edges: common_neighbors(edges, TOP).collect(),
    "top_k_jc": lambda edges: jaccard(edges, TOP).collect(),
    "top_k_aa": lambda edges: adamic_adar(edges, TOP).collect(),
}


def _hub_graph(spark: SparkSession, n: int) -> DataFrame:
    """A hub with n neighbours that form a ring: half of all rows are the hub's, and its pairs would be n * n / 2."""
    star = spark.range(1, n + 1).selectExpr("0L AS a", "id AS b")
    ring = spark.range(1, n + 1).selectExpr("id AS a", f"1 + id % {n} AS b")
    link = star.union(ring)
    return link.selectExpr("a AS src", "b AS dst").union(link.selectExpr("b", "a"))


def main() -> None:
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        start = time.time()
        graphs.co_returned(spark, SF_DIR).write.parquet(f"{folder}/edges")
        graph_seconds = time.time() - start
        edges = read_edge_table(spark, f"{folder}/edges")
        size = {
            "edge_rows": edges.count(),
            "wedges": wedges(edges).count(),
            "candidate_pairs": common_neighbors(edges).count(),
        }
        _hub_graph(spark, HUB).write.parquet(f"{folder}/hub")
        hub = read_edge_table(spark, f"{folder}/hub")
        timed = [(name, name, edges) for name in QUERIES] + [(f"hub_{name}", name, hub) for name in QUERIES if name.startswith("top_k")]
        seconds: dict[str, float] = {}
        for shown, name, graph in timed:
            runs = []
            for _ in range(RUNS + 1):  # the first one warms up
                start = time.time()
                with scratch(spark):
                    QUERIES[name](graph)
                runs.append(time.time() - start)
            seconds[shown] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (median of runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
                "cpus": int(CPUS),
                "driver_memory": memory,
                "runs": RUNS,
                "hub_neighbours": HUB,
                **size,
                "wedges_per_sec": round(size["wedges"] / seconds["link_scores"]),
                "pairs_per_sec": round(size["candidate_pairs"] / seconds["link_scores"]),
                "write_graph_sec": round(graph_seconds, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
