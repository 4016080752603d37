from twohop.plans.measures import (
    adamic_adar,
    common_neighbors,
    jaccard,
    link_scores,
    pair_totals,
    with_degree_total,
)

__all__ = ["adamic_adar", "common_neighbors", "jaccard", "link_scores", "pair_totals", "with_degree_total"]
