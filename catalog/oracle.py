"""The same queries as SQL over the given tables, written from the definitions and not from the plans."""

from __future__ import annotations

TOP = 100

_BAG = """e AS (
  SELECT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
  AND a.l_returnflag = b.l_returnflag WHERE a.l_partkey <> b.l_partkey)"""
_SIMPLE = _BAG.replace("SELECT a.l", "SELECT DISTINCT a.l")
_SUPPLY = """e AS (
  SELECT o_custkey AS src, l_suppkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_suppkey IS NOT NULL)"""

_DEGREE = "deg AS (SELECT src AS node, count(*) AS degree FROM e GROUP BY src)"
_WEDGE = """w AS (SELECT a.src AS k, a.dst AS u, b.dst AS v FROM e a JOIN e b ON a.src = b.src WHERE a.dst < b.dst)"""
_WEDGE_NE = _WEDGE.replace("a.dst < b.dst", "a.dst <> b.dst").replace("w AS", "wne AS")
_OPEN = "NOT EXISTS (SELECT 1 FROM e WHERE e.src = w.u AND e.dst = w.v)"
_CN = f"cn AS (SELECT u, v, count(*) AS cn FROM w WHERE {_OPEN} GROUP BY u, v)"
# Ordered unconnected pairs with the degree of their first node.
_ENDS = """ends AS (
  SELECT p.u, p.v, d.degree FROM (SELECT DISTINCT u, v FROM wne) p JOIN deg d ON d.node = p.u
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.src = p.u AND e.dst = p.v))"""
_TOTAL = """t AS (SELECT least(u, v) AS u, greatest(u, v) AS v, CAST(sum(degree) AS BIGINT) AS total FROM ends GROUP BY 1, 2)"""
_JC_OF = """CASE WHEN total = cn THEN CAST('Infinity' AS DOUBLE) ELSE CAST(cn AS DOUBLE) / CAST(total - cn AS DOUBLE) END"""
_JC = f"jc AS (SELECT cn.u, cn.v, {_JC_OF} AS score FROM cn JOIN t ON cn.u = t.u AND cn.v = t.v)"
# Weights in units of 1e-12, summed as whole numbers, as the library defines them.
_WEIGHT = "CASE WHEN degree > 1 THEN CAST(round(1e12 / log10(degree)) AS BIGINT) END"
_AA_SUM = f"CAST(sum({_WEIGHT}) AS HUGEINT)"
_AA_OF = "CAST(s AS DOUBLE) / 1e12"
_AA = f"""aa AS (SELECT u, v, {_AA_OF} AS score FROM (
  SELECT u, v, {_AA_SUM} AS s FROM w JOIN deg ON deg.node = w.k WHERE {_OPEN} GROUP BY u, v))"""

_EVENT_LINES = """lines AS (
  SELECT CASE event_type
    WHEN 'view' THEN concat(user_id, ' ', event_id, ' ')
    WHEN 'purchase' THEN concat(' ', user_id, chr(9), event_id, ' ', props)
    WHEN 'signup' THEN concat(user_id, ' ', event_id, ' # ', event_type)
    WHEN 'click' THEN concat(user_id, ' ', event_type)
    WHEN 'error' THEN concat(event_type, ' ', user_id)
    ELSE concat(user_id) END AS value FROM events)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _top(score: str) -> str:
    return f"SELECT u, v, score FROM {score} ORDER BY score DESC, u, v LIMIT {TOP}"


def _report(measure: str, score: str, line: str) -> str:
    return f"""SELECT '{measure}' AS measure, row_number() OVER (ORDER BY score DESC, u, v) AS rank, {line} AS line
      FROM ({_top(score)})"""


_JACCARD_PARTS = (_DEGREE, _WEDGE, _WEDGE_NE, _CN, _ENDS, _TOTAL, _JC)
_CN_SCORE = "cns AS (SELECT u, v, cn AS score FROM cn)"
_LABEL = "concat(u, ' <-> ', v)"
_DECIMAL_LINE = f"concat(printf('%.5f', round(score, 5)), ', ', {_LABEL})"

ORACLE: dict[str, str] = {
    "edge_scan": """SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL""",
    "comment_filter": _with(_EVENT_LINES) + "SELECT value FROM lines WHERE value NOT LIKE '%#%'",
    "edge_parse": _with(_SIMPLE) + "SELECT src, dst FROM e",
    "bad_rows": _with(_EVENT_LINES)
    + r"""SELECT value, CASE
        WHEN regexp_matches(value, '^\s*$') THEN 'blank line'
        WHEN regexp_matches(value, '^\s*\S+\s*$') THEN 'one id only'
        WHEN NOT regexp_matches(value, '^\s*[0-9]+\s') THEN 'source id is not an integer'
        ELSE 'target id is not an integer' END AS reason
      FROM lines WHERE value NOT LIKE '%#%' AND NOT regexp_matches(value, '^\s*[0-9]+\s+[0-9]+(\s|$)')""",
    "ranked_report": _with(_SIMPLE, *_JACCARD_PARTS, _CN_SCORE, _AA)
    + " UNION ALL ".join(
        [
            _report("common_neighbors", "cns", f"concat('(', score, ',', {_LABEL}, ')')"),
            _report("jaccard", "jc", _DECIMAL_LINE),
            _report("adamic_adar", "aa", _DECIMAL_LINE),
        ]
    ),
    "wedge_join": _with(_BAG)
    + """SELECT a.src AS k, count(*) AS wedges, CAST(sum(a.dst) AS BIGINT) AS sum_u, CAST(sum(a.dst * b.dst) AS BIGINT) AS sum_uv
        FROM e a JOIN e b ON a.src = b.src GROUP BY 1""",
    "wedge_pairs": _with(_SIMPLE, _WEDGE) + "SELECT u, v, count(*) AS instances FROM w GROUP BY u, v",
    "wedges_with_middle": _with(_SIMPLE, _WEDGE)
    + "SELECT k, count(*) AS wedges, CAST(sum(u) AS BIGINT) AS sum_u, CAST(sum(v) AS BIGINT) AS sum_v FROM w GROUP BY k",
    "two_hop_ordered": _with(_SIMPLE, _WEDGE_NE)
    + """SELECT u AS node, count(*) AS partners, CAST(sum(n) AS BIGINT) AS instances, CAST(sum(v) AS BIGINT) AS sum_partners
        FROM (SELECT u, v, count(*) AS n FROM wne GROUP BY u, v) GROUP BY u""",
    "pair_canonical": _with(_SUPPLY)
    + "SELECT least(src, dst) AS u, greatest(src, dst) AS v, count(*) AS edge_rows FROM e GROUP BY 1, 2",
    "pair_label": _with(_SIMPLE, _WEDGE) + f"SELECT DISTINCT {_LABEL} AS label FROM w WHERE {_OPEN}",
    "non_edges": _with(_BAG, _WEDGE) + f"SELECT k, count(*) AS open_wedges FROM w WHERE {_OPEN} GROUP BY k",
    "endpoint_degrees": _with(_SIMPLE, _DEGREE, _WEDGE_NE, _ENDS) + "SELECT u, v, degree FROM ends",
    "middle_degrees": _with(_SIMPLE, _DEGREE, _WEDGE)
    + "SELECT k, degree, count(*) AS wedges FROM w JOIN deg ON node = k GROUP BY k, degree",
    "cn_with_total": _with(_SIMPLE, *_JACCARD_PARTS)
    + "SELECT cn.u, cn.v, cn, total FROM cn JOIN t ON cn.u = t.u AND cn.v = t.v",
    "candidate_semi": _with(_SIMPLE, _DEGREE, _WEDGE)
    + f"""SELECT u, v, CAST(sum(degree) AS BIGINT) AS degree_sum FROM w JOIN deg ON node = k WHERE {_OPEN} GROUP BY u, v""",
    "node_degree": _with(_BAG, _DEGREE) + "SELECT node, degree FROM deg",
    "cn_count": _with(_BAG, _WEDGE, _CN) + "SELECT u, v, cn FROM cn",
    "pair_degree_sum": _with(_SIMPLE, _DEGREE, _WEDGE_NE, _ENDS, _TOTAL) + "SELECT u, v, total FROM t",
    "shared_degree_list": _with(_SIMPLE, _DEGREE, _WEDGE)
    + "SELECT u, v, degree, count(*) AS shared FROM w JOIN deg ON node = k GROUP BY u, v, degree",
    "aa_sum": _with(_SIMPLE, _DEGREE, _WEDGE)
    + f"SELECT u, v, {_AA_OF} AS aa FROM (SELECT u, v, {_AA_SUM} AS s FROM w JOIN deg ON node = k GROUP BY u, v)",
    "distinct_pairs": _with(_SIMPLE, _WEDGE) + "SELECT DISTINCT u, v FROM w",
    "top_k_cn": _with(_SIMPLE, _WEDGE, _CN, _CN_SCORE) + _top("cns"),
    "top_k_jc": _with(_SIMPLE, *_JACCARD_PARTS) + _top("jc"),
    "top_k_aa": _with(_SIMPLE, _DEGREE, _WEDGE, _AA) + _top("aa"),
    "common_neighbors": _with(_SIMPLE, _WEDGE, _CN, _CN_SCORE) + "SELECT u, v, score FROM cns",
    "jaccard": _with(_SIMPLE, *_JACCARD_PARTS) + "SELECT u, v, score FROM jc",
    "top_k_jaccard_as_is": _with(_SUPPLY, *_JACCARD_PARTS) + _top("jc"),
    "jaccard_as_is": _with(_SUPPLY, *_JACCARD_PARTS) + "SELECT u, v, score FROM jc",
    "adamic_adar": _with(_SIMPLE, _DEGREE, _WEDGE, _AA) + "SELECT u, v, score FROM aa",
    "link_scores": _with(
        _SIMPLE.replace("e AS (", "e AS MATERIALIZED ("),
        _DEGREE.replace("deg AS (", "deg AS MATERIALIZED ("),
        f"sums AS MATERIALIZED (SELECT a.dst AS u, b.dst AS v, count(*) AS cn, {_AA_SUM} AS s "
        "FROM e a JOIN e b ON a.src = b.src AND a.dst < b.dst JOIN deg ON deg.node = a.src GROUP BY 1, 2)",
        "open_pairs AS MATERIALIZED (SELECT * FROM sums WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.src = sums.u AND e.dst = sums.v))",
        # The degree of v counts unless v -> u is an edge; a node without edges of its own has none.
        """totals AS (SELECT p.*, CASE WHEN r.src IS NULL THEN dv.degree END AS second, du.degree AS first FROM open_pairs p
          LEFT JOIN deg du ON du.node = p.u LEFT JOIN deg dv ON dv.node = p.v LEFT JOIN e r ON r.src = p.v AND r.dst = p.u)""",
        """whole AS (SELECT *, CASE WHEN first IS NOT NULL OR second IS NOT NULL THEN coalesce(first, 0) + coalesce(second, 0) END AS total FROM totals)""",
    )
    + f"SELECT u, v, cn, {_JC_OF.replace('CASE WHEN', 'CASE WHEN total IS NULL THEN NULL WHEN')} AS jc, {_AA_OF} AS aa FROM whole",
    "symmetrize": _with(_SUPPLY) + "SELECT src, dst FROM e UNION SELECT dst, src FROM e",
    "simple_graph": _with(_SUPPLY) + "SELECT DISTINCT src, dst FROM e WHERE src <> dst",
    "contract_report": _with(_SUPPLY)
    + """SELECT count(*) AS edge_rows, count(DISTINCT (src, dst)) AS distinct_edges,
        count(*) - count(DISTINCT (src, dst)) AS duplicate_rows, count(*) FILTER (src = dst) AS loop_rows,
        count(*) FILTER (NOT EXISTS (SELECT 1 FROM e r WHERE r.src = e.dst AND r.dst = e.src)) AS asymmetric_rows FROM e""",
}
