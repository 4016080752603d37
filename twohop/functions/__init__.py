from twohop.functions.scores import (
    WEIGHT_SCALE,
    adamic_adar_score,
    inverse_log_weight,
    jaccard_ratio,
    pair_label,
    score_text,
    weight_parts,
)

__all__ = [
    "WEIGHT_SCALE",
    "adamic_adar_score",
    "inverse_log_weight",
    "jaccard_ratio",
    "pair_label",
    "score_text",
    "weight_parts",
]
