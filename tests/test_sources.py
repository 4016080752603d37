from __future__ import annotations

import gzip

import pytest

from twohop.sources import bad_rows, drop_comments, parse_edges, read_edge_list, read_edge_table

SMALL = "# comment1\n# comment2\n2 1 \n1 3 \n4 2 \n3 4 \n5 3 \n4 5 \n1 2 \n3 1 \n2 4 \n4 3 \n3 5 \n5 4  \n"


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def pairs(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "line, edge",
    [
        ("1\t2", (1, 2)),
        ("1 2 0.5", (1, 2)),
        ("2 1 ", (2, 1)),
        (" 1 2", (1, 2)),
        ("\t1 \x0b\x0c 2\t", (1, 2)),
        ("01 2", (1, 2)),
        ("-7 +5", (-7, 5)),
        ("3000000000 1", (3000000000, 1)),
        ("1 3000000000", (1, 3000000000)),
    ],
)
def test_good_lines(spark, line, edge):
    assert pairs(parse_edges(lines_of(spark, line))) == [edge]


@pytest.mark.parametrize(
    "line, reason",
    [
        ("", "blank line"),
        (" \t ", "blank line"),
        ("7", "one id only"),
        ("7 ", "one id only"),
        ("foo 1", "source id is not an integer"),
        ("1 foo", "target id is not an integer"),
        ("1.5 2", "source id is not an integer"),
        ("1 99999999999999999999", "target id is not an integer"),
    ],
)
def test_malformed_lines(spark, line, reason):
    lines = lines_of(spark, "1 2", line)
    assert pairs(bad_rows(lines)) == [(line, reason)]
    assert pairs(parse_edges(lines, mode="permissive")) == [(1, 2)]
    with pytest.raises(Exception, match="malformed edge line"):
        parse_edges(lines).count()


def test_comments(spark):
    lines = lines_of(spark, "# comment", " # indented", "1 2 # note", "3 4")
    assert pairs(drop_comments(lines)) == [("3 4",)]
    assert pairs(parse_edges(lines)) == [(3, 4)]
    assert pairs(parse_edges(lines, comment="prefix")) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError):
        drop_comments(lines, "suffix")
    with pytest.raises(ValueError):
        parse_edges(lines, mode="lenient")


def test_duplicates_and_direction_are_kept(spark):
    lines = lines_of(spark, "1 2", "1 2", "2 2")
    assert sorted(pairs(parse_edges(lines))) == [(1, 2), (1, 2), (2, 2)]


def test_text_files(spark, tmp_path):
    expected = sorted((int(a), int(b)) for a, b in (line.split() for line in SMALL.splitlines()[2:]))
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.txt").write_text(SMALL)
    with gzip.open(tmp_path / "plain" / "b.txt.gz", "wt") as file:
        file.write("8 9\r\n")
    assert sorted(pairs(read_edge_list(spark, str(tmp_path / "plain" / "a.txt")))) == expected
    assert sorted(pairs(read_edge_list(spark, str(tmp_path / "plain")))) == sorted([*expected, (8, 9)])
    assert pairs(read_edge_list(spark, str(tmp_path / "plain" / "*.gz"))) == [(8, 9)]


def test_edge_table_reads_two_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, "x"), (None, 3, "y"), (4, 5, "z")], "a int, b int, note string").write.parquet(path)
    edges = read_edge_table(spark, path, "a", "b")
    assert sorted(pairs(edges)) == [(1, 2), (4, 5)]
    assert "note" not in edges._jdf.queryExecution().executedPlan().toString()
