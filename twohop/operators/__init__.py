from twohop.operators.graph import (
    cached,
    contract_report,
    degrees,
    edge_bag,
    folded,
    simple_graph,
    symmetrize,
    written_bag,
)
from twohop.operators.nodes import attach, source_nodes
from twohop.operators.pairs import (
    canonical_pairs,
    candidate_semi,
    distinct_pairs,
    endpoint_degrees,
    non_edges,
    pair_degree_sum,
    ranked,
    top_k,
    with_label,
)
from twohop.operators.wedges import middle_weights, pair_parts, two_hop_pairs, wedges

__all__ = [
    "attach",
    "cached",
    "candidate_semi",
    "canonical_pairs",
    "contract_report",
    "degrees",
    "distinct_pairs",
    "edge_bag",
    "endpoint_degrees",
    "folded",
    "middle_weights",
    "non_edges",
    "pair_degree_sum",
    "pair_parts",
    "ranked",
    "simple_graph",
    "source_nodes",
    "symmetrize",
    "top_k",
    "two_hop_pairs",
    "wedges",
    "with_label",
    "written_bag",
]
