from twohop.sources.edge_list import (
    bad_rows,
    drop_comments,
    parse_edges,
    read_edge_list,
    read_lines,
    split_lines,
)
from twohop.sources.edge_table import edge_table, read_edge_table

__all__ = [
    "bad_rows",
    "drop_comments",
    "edge_table",
    "parse_edges",
    "read_edge_list",
    "read_edge_table",
    "read_lines",
    "split_lines",
]
