"""Scores for missing links of a graph, as Spark DataFrames."""

from twohop.plans import adamic_adar, common_neighbors, jaccard, link_scores
from twohop.sources import read_edge_list, read_edge_table
from twohop.tuning import Tuning

__all__ = [
    "Tuning",
    "adamic_adar",
    "common_neighbors",
    "jaccard",
    "link_scores",
    "read_edge_list",
    "read_edge_table",
]
