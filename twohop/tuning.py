"""Sizes that steer how hub nodes are split. None of them changes a result."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Tuning:
    """``slice_rows``: a node's edge rows are cut into slices of about this many rows, and every
    two slices meet in their own join group, so no join group grows with the node.

    ``light_fan_out``: the pruned top-k expands sources with up to this many targets in full, which costs
    at most half as many wedges per edge row, and larger ones only where a pair may still rank.

    ``part_wedges``: about so many wedges are added up in one task.

    ``edge_wedges``: up to so many wedges an edge row, the top k of a graph of more than one part is taken from all pairs.
    """

    slice_rows: int = 2_000
    light_fan_out: int = 128
    part_wedges: int = 2_000_000
    edge_wedges: int = 50


DEFAULT = Tuning()
