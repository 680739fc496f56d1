"""Oracle SQL (DuckDB dialect) for every query of ``plans.catalog``.

Each statement computes the same result as the Spark query from the same
tables, written independently as plain SQL: the k-means fit is a recursive
CTE, the seed sample a ``row_number`` over the same md5 keys, the median a
``median`` over all rows of a group. Column names and types follow the Spark
results (sums are cast back to BIGINT, DuckDB's ``//`` truncates toward zero
like Spark's ``div``).
"""

from __future__ import annotations

from postclust.params import Params
from postclust.plans.catalog import CAPPED, FAR_CENTER, KNOWN_ONLY, NARROW, UNKNOWN, WIDE


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


POSTINGS = """
postings AS (
  SELECT 1 AS posting_type, CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS id,
         CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey * 10 + 1 AS BIGINT) END AS accepted_answer,
         CAST(NULL AS BIGINT) AS parent_id, CAST(o_orderkey % 41 - 20 AS INTEGER) AS score, o_orderpriority AS tags
  FROM orders
  UNION ALL
  SELECT CASE WHEN (l_orderkey * 10 + l_linenumber) % 89 = 0 THEN 3 ELSE 2 END,
         l_orderkey * 10 + l_linenumber, CAST(NULL AS BIGINT),
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 97 <> 0 THEN l_orderkey END,
         CAST(floor(l_extendedprice / 100) AS INTEGER) - 300, CAST(NULL AS VARCHAR)
  FROM lineitem),
q AS (
  SELECT id AS question_id, tags, score AS question_score, accepted_answer
  FROM postings WHERE posting_type = 1),
a AS (
  SELECT parent_id AS question_id, id AS answer_id, score AS answer_score
  FROM postings WHERE posting_type = 2 AND parent_id IS NOT NULL)"""

SCORED = POSTINGS + """,
scored AS (
  SELECT uq.question_id, uq.m.t AS tags, uq.m.s AS question_score, uq.m.a AS accepted_answer,
         greatest(0, ba.best) AS high_score
  FROM (SELECT question_id,
               min(struct_pack(tn := tags IS NULL, t := tags, s := question_score,
                               an := accepted_answer IS NULL, a := accepted_answer)) AS m
        FROM q GROUP BY question_id) uq
  JOIN (SELECT question_id, max(answer_score) AS best FROM a GROUP BY question_id) ba
    ON uq.question_id = ba.question_id)"""


# Questions and answers straight from their tables, for the joins.
_QUESTION_ID = "CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey - 1 ELSE o_orderkey END"
_ANSWER_ID = "(l_orderkey * 10 + l_linenumber)"


def _pairs_sql(join: str) -> str:
    return f"""
SELECT question_id, tags, question_score, answer_id, answer_score
FROM (SELECT {_QUESTION_ID} AS question_id, o_orderpriority AS tags, CAST(o_orderkey % 41 - 20 AS INTEGER) AS question_score
      FROM orders) q
{join} (SELECT l_orderkey AS parent_id, {_ANSWER_ID} AS answer_id, CAST(floor(l_extendedprice / 100) AS INTEGER) - 300 AS answer_score
      FROM lineitem WHERE {_ANSWER_ID} % 89 <> 0 AND {_ANSWER_ID} % 97 <> 0) a ON parent_id = question_id"""


def _pair_stats_sql(join: str) -> str:
    return f"""
SELECT question_id, count(*) AS n_rows, count(answer_id) AS n_answers, CAST(sum(answer_score) AS BIGINT) AS sum_score,
       min(answer_score) AS least_score, max(answer_score) AS best_score, max(answer_id) AS last_answer,
       min(tags) AS first_tag, CAST(sum(question_score) AS BIGINT) AS sum_question_score
FROM ({_pairs_sql(join)}) p GROUP BY question_id"""


def _langs_values(params: Params) -> str:
    rows = ", ".join(f"({_lit(l)}, {i})" for i, l in enumerate(params.langs))
    return f"langs(lang, idx) AS (VALUES {rows})"


def _vec(params: Params) -> str:
    return f"""
{_langs_values(params)},
vec AS (
  SELECT * FROM (
    SELECT s.question_id, CAST(coalesce(l.idx * {params.spread}, -1) AS INTEGER) AS x, s.high_score AS y
    FROM scored s LEFT JOIN langs l ON s.tags = l.lang)
  {"WHERE x <> -1" if params.drop_unknown else ""}),
w AS (SELECT x, y, CAST(count(*) AS BIGINT) AS n FROM vec GROUP BY x, y)"""


def _seed(params: Params) -> str:
    key = f"md5('{params.seed}:' || CAST(question_id AS VARCHAR))"
    if params.global_sample:
        return f"""
seed AS (
  SELECT CAST(row_number() OVER (ORDER BY h, question_id) - 1 AS INTEGER) AS cid, question_id, x, y
  FROM (SELECT question_id, x, y, {key} AS h FROM vec ORDER BY h, question_id LIMIT {params.kernels}))"""
    return f"""
seed AS (
  SELECT CAST(row_number() OVER (ORDER BY x, rn) - 1 AS INTEGER) AS cid, question_id, x, y
  FROM (SELECT question_id, x, y,
               row_number() OVER (PARTITION BY x ORDER BY {key}, question_id) AS rn
        FROM vec) r
  WHERE rn <= {params.per_lang})"""


def _dist(px: str, py: str, cx: str, cy: str) -> str:
    return (f"(CAST({px} AS DOUBLE) - {cx}) * (CAST({px} AS DOUBLE) - {cx}) + "
            f"(CAST({py} AS DOUBLE) - {cy}) * (CAST({py} AS DOUBLE) - {cy})")


def _means_of(points: str, centers: str) -> str:
    """Per-cluster integer centroid of weighted points ``points(x, y, n)``
    assigned to ``centers(cid, mx, my)``."""
    return f"""
    SELECT cid,
           CAST(CAST(sum(CAST(x AS BIGINT) * n) AS BIGINT) // CAST(sum(n) AS BIGINT) AS INTEGER) AS nx,
           CAST(CAST(sum(CAST(y AS BIGINT) * n) AS BIGINT) // CAST(sum(n) AS BIGINT) AS INTEGER) AS ny
    FROM (SELECT p.x, p.y, p.n, arg_min(c.cid, ({_dist('p.x', 'p.y', 'c.mx', 'c.my')}, c.cid)) AS cid
          FROM {points} p CROSS JOIN {centers} c
          GROUP BY p.x, p.y, p.n) t
    GROUP BY cid"""


def _fit(params: Params) -> str:
    return f"""
km(it, cid, mx, my, shift) AS (
  SELECT 0, cid, x, y, CAST('infinity' AS DOUBLE) FROM seed
  UNION ALL
  SELECT it + 1, cid, nx, ny,
         sum({_dist('nx', 'ny', 'mx', 'my')}) OVER ()
  FROM (
    SELECT m.it, m.cid, m.mx, m.my, coalesce(u.nx, m.mx) AS nx, coalesce(u.ny, m.my) AS ny
    FROM km m
    LEFT JOIN ({_means_of('w', 'km')}) u ON m.cid = u.cid
    WHERE m.shift >= {float(params.eta)!r} AND m.it < {params.max_iterations}) step),
final AS (SELECT cid, mx, my FROM km WHERE it = (SELECT max(it) FROM km))"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def _summary_ctes(params: Params) -> str:
    return f"""
asg AS (
  SELECT v.question_id, v.x, v.y, arg_min(f.cid, ({_dist('v.x', 'v.y', 'f.mx', 'f.my')}, f.cid)) AS cid
  FROM vec v CROSS JOIN final f GROUP BY v.question_id, v.x, v.y),
per_lang AS (
  SELECT cid, x, CAST(count(*) AS BIGINT) AS n, CAST(trunc(median(y)) AS INTEGER) AS median_score
  FROM asg GROUP BY cid, x),
summary AS (
  SELECT cid,
         ({_lang_array(params)})[CAST(arg_max(x, (n, -x)) // {params.spread} AS INTEGER) + 1] AS lang,
         max(n) * CAST(100.0 AS DOUBLE) / CAST(sum(n) AS BIGINT) AS pct,
         CAST(sum(n) AS BIGINT) AS size,
         arg_max(median_score, (n, -x)) AS median_score
  FROM per_lang GROUP BY cid)"""


def _lang_array(params: Params) -> str:
    return "[" + ", ".join(_lit(l) for l in params.langs) + "]"


def _uniform(key: str) -> str:
    """The first 52 bits of the row's md5, as a number in [0, 1)."""
    return f"(CAST('0x' || substr(md5('0:' || CAST({key} AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _poisson_steps(rate: float) -> str:
    """``p``: the probability of a Poisson count of at most 0, 1, 2, ... 17."""
    return f"""
      WITH RECURSIVE s(k, term, p) AS (
        SELECT 0, exp(-{rate}::DOUBLE), exp(-{rate}::DOUBLE)
        UNION ALL SELECT k + 1, term * ({rate}::DOUBLE / (k + 1)), p + term * ({rate}::DOUBLE / (k + 1)) FROM s WHERE k < 17)
      SELECT p FROM s"""


# ---- parser ------------------------------------------------------------------

def _render(src: str) -> str:
    cols = ["posting_type", "id", "accepted_answer", "parent_id", "score", "tags"]
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + f" AS value FROM {src}"


def _is_int(s: str, typ: str) -> str:
    return f"(regexp_full_match({s}, '[+-]?[0-9]+') AND TRY_CAST({s} AS {typ}) IS NOT NULL)"


def _parse_ctes(lines_sql: str) -> str:
    f = [f"parts[{i + 1}]" for i in range(6)]
    opt_bad = lambda s: f"({s} <> '' AND NOT {_is_int(s, 'BIGINT')})"
    return f"""
lines AS ({lines_sql}),
split AS (
  SELECT value,
         (length(regexp_replace(value, ',+$', '')) = 0 AND length(value) > 0) AS no_field,
         string_split(regexp_replace(value, ',+$', ''), ',') AS parts
  FROM lines),
checked AS (
  SELECT value, parts,
    CASE
      WHEN no_field OR {f[0]} IS NULL THEN 'posting_type: missing'
      WHEN NOT {_is_int(f[0], 'INTEGER')} THEN 'posting_type: not an int'
      WHEN {f[1]} IS NULL THEN 'id: missing'
      WHEN NOT {_is_int(f[1], 'BIGINT')} THEN 'id: not an int'
      WHEN {f[2]} IS NULL THEN 'accepted_answer: missing'
      WHEN {opt_bad(f[2])} THEN 'accepted_answer: not an int'
      WHEN {f[3]} IS NULL THEN 'parent_id: missing'
      WHEN {opt_bad(f[3])} THEN 'parent_id: not an int'
      WHEN {f[4]} IS NULL THEN 'score: missing'
      WHEN NOT {_is_int(f[4], 'INTEGER')} THEN 'score: not an int'
    END AS reason
  FROM split)"""


def _parsed_columns() -> str:
    return """
  TRY_CAST(parts[1] AS INTEGER) AS posting_type,
  TRY_CAST(parts[2] AS BIGINT) AS id,
  CASE WHEN parts[3] <> '' THEN TRY_CAST(parts[3] AS BIGINT) END AS accepted_answer,
  CASE WHEN parts[4] <> '' THEN TRY_CAST(parts[4] AS BIGINT) END AS parent_id,
  TRY_CAST(parts[5] AS INTEGER) AS score,
  parts[6] AS tags"""


def _feed_sql() -> str:
    return (f"SELECT {_render('postings')} UNION ALL "
            "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")


# The report's text, spelled out here so that a wrong layout shows.
HEADER_LINES = [
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
]
ROW_FORMAT = "%7d  %-17s (%-5s%%)      %7d"  # the percentage is rounded half up to one place before


# ---- statements --------------------------------------------------------------

def _report_sql(params: Params) -> str:
    header = " UNION ALL ".join(
        f"SELECT {i + 1} AS line_no, {_lit(t)} AS line" for i, t in enumerate(HEADER_LINES)
    )
    return (_with(SCORED, _vec(params), _seed(params), _fit(params), _summary_ctes(params))
            + f"""
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM ({header}) h
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY median_score, cid) + {len(HEADER_LINES)} AS INTEGER) AS line_no,
       printf({_lit(ROW_FORMAT)}, median_score, lang,
         CAST(round(CAST(pct AS DECIMAL(18, 12)), 1) AS DECIMAL(18, 1))::VARCHAR, size) AS line
FROM summary""")


def _trace_sql(params: Params) -> str:
    return _with(SCORED, _vec(params), _seed(params), _fit(params)) + f"""
SELECT CAST(k.it AS INTEGER) AS it, CAST(k.cid AS INTEGER) AS cid,
       CAST(p.mx AS INTEGER) AS old_x, CAST(p.my AS INTEGER) AS old_y,
       CAST(k.mx AS INTEGER) AS new_x, CAST(k.my AS INTEGER) AS new_y,
       {_dist('k.mx', 'k.my', 'p.mx', 'p.my')} AS shift,
       k.shift AS total_shift, k.shift < {float(params.eta)!r} AS converged
FROM km k JOIN km p ON p.it = k.it - 1 AND p.cid = k.cid"""


def _step_sql(select: str) -> str:
    far = f"SELECT CAST((SELECT count(*) FROM seed) AS INTEGER) AS cid, {FAR_CENTER[0]} AS mx, {FAR_CENTER[1]} AS my"
    return (_with(SCORED, _vec(WIDE), _seed(WIDE))
            + f""",
start AS (SELECT cid, x AS mx, y AS my FROM seed UNION ALL {far}),
moved AS (
  SELECT s.cid, CAST(coalesce(u.nx, s.mx) AS INTEGER) AS mx, CAST(coalesce(u.ny, s.my) AS INTEGER) AS my
  FROM start s LEFT JOIN ({_means_of('w', 'start')}) u ON s.cid = u.cid)
{select}""")


def oracle_sql() -> dict[str, str]:
    base = "WITH " + POSTINGS
    wide_vec = _with(SCORED, _vec(WIDE))
    return {
        "q_parse_postings": _with(POSTINGS, _parse_ctes(f"SELECT {_render('postings')}"))
        + f"\nSELECT {_parsed_columns()} FROM checked",
        "q_text_postings": _with(POSTINGS, _parse_ctes(f"SELECT {_render('postings')}"))
        + f"\nSELECT {_parsed_columns()} FROM checked",
        "q_quarantine": _with(POSTINGS, _parse_ctes(_feed_sql()))
        + "\nSELECT value, reason FROM checked WHERE reason IS NOT NULL",
        "q_bad_records": _with(POSTINGS, _parse_ctes(_feed_sql()))
        + "\nSELECT value, reason FROM checked WHERE reason IS NOT NULL",
        "q_questions": base + "\nSELECT question_id, tags, question_score, accepted_answer FROM q",
        "q_answers": base + "\nSELECT question_id, answer_id, answer_score FROM a",
        "q_join_pairs": _pairs_sql("JOIN"),
        "q_join_pairs_salted": _pairs_sql("JOIN"),
        "q_left_join_questions": _pairs_sql("LEFT JOIN"),
        "q_join_pairs_stats": _pair_stats_sql("JOIN"),
        "q_left_join_stats": _pair_stats_sql("LEFT JOIN"),
        "q_stored_left_pairs": _pair_stats_sql("LEFT JOIN"),
        "q_stored_scores": "WITH " + SCORED
        + "\nSELECT question_id, tags, question_score, accepted_answer, high_score FROM scored",
        "q_grouped_counts": base + """
SELECT q.question_id, CAST(count(*) AS BIGINT) AS n_pairs
FROM q JOIN a ON a.question_id = q.question_id GROUP BY q.question_id""",
        "q_scored_questions": "WITH " + SCORED
        + "\nSELECT question_id, tags, question_score, accepted_answer, high_score FROM scored",
        "q_vectors": wide_vec + "\nSELECT question_id, x, y FROM vec",
        "q_vectors_unknown": _with(SCORED, _vec(UNKNOWN)) + "\nSELECT question_id, x, y FROM vec",
        "q_lang_labels": _with(SCORED, _vec(UNKNOWN)) + f"""
SELECT question_id, x, CAST(x // {UNKNOWN.spread} AS INTEGER) AS lang_index,
       ({_lang_array(UNKNOWN)})[CAST(x // {UNKNOWN.spread} AS INTEGER) + 1] AS lang
FROM vec""",
        "q_weighted_points": wide_vec + "\nSELECT x, y, n FROM w",
        "q_sample_per_language": _with(SCORED, _vec(WIDE), _seed(WIDE))
        + "\nSELECT cid, question_id, x, y FROM seed",
        "q_sample_global": _with(SCORED, _vec(NARROW), _seed(NARROW))
        + "\nSELECT cid, question_id, x, y FROM seed",
        "q_sample_bernoulli": wide_vec + f"""
SELECT question_id, x, y FROM vec WHERE {_uniform("question_id")} < 0.1""",
        "q_sample_poisson": wide_vec + f"""
SELECT question_id, x, y FROM (
  SELECT question_id, x, y, unnest(range((SELECT count(*) FROM ({_poisson_steps(0.5)}) WHERE p <= u))) AS draw
  FROM (SELECT *, {_uniform("question_id")} AS u FROM vec))""",
        "q_sample_sizes": _with(SCORED, _vec(WIDE), _seed(WIDE)) + f"""
SELECT x, count(*) AS n, count(*) = {WIDE.per_lang} AS complete FROM seed GROUP BY x""",
        "q_assign": _with(SCORED, _vec(WIDE), _seed(WIDE)) + f"""
SELECT v.question_id, v.x, v.y, arg_min(s.cid, ({_dist('v.x', 'v.y', 's.x', 's.y')}, s.cid)) AS cid
FROM vec v CROSS JOIN seed s GROUP BY v.question_id, v.x, v.y""",
        "q_kmeans_step": _step_sql("SELECT cid, mx, my FROM moved"),
        "q_center_shift": _step_sql(f"""
SELECT sum({_dist('m.mx', 'm.my', 's.mx', 's.my')}) AS total_shift,
       sum({_dist('m.mx', 'm.my', 's.mx', 's.my')}) < {float(WIDE.eta)!r} AS converged
FROM moved m JOIN start s ON m.cid = s.cid"""),
        "q_kmeans_fit_wide": _with(SCORED, _vec(WIDE), _seed(WIDE), _fit(WIDE))
        + "\nSELECT CAST(cid AS INTEGER) AS cid, CAST(mx AS INTEGER) AS mx, CAST(my AS INTEGER) AS my FROM final",
        "q_kmeans_fit_narrow": _with(SCORED, _vec(NARROW), _seed(NARROW), _fit(NARROW))
        + "\nSELECT CAST(cid AS INTEGER) AS cid, CAST(mx AS INTEGER) AS mx, CAST(my AS INTEGER) AS my FROM final",
        "q_kmeans_trace": _trace_sql(WIDE),
        "q_kmeans_trace_capped": _trace_sql(CAPPED),
        "q_cluster_lang_counts": _with(SCORED, _vec(NARROW), _seed(NARROW), _fit(NARROW), _summary_ctes(NARROW))
        + "\nSELECT cid, x, n, median_score FROM per_lang",
        "q_cluster_summary": _with(SCORED, _vec(WIDE), _seed(WIDE), _fit(WIDE), _summary_ctes(WIDE))
        + "\nSELECT cid, lang, pct, size, median_score FROM summary",
        "q_cluster_summary_narrow": _with(SCORED, _vec(NARROW), _seed(NARROW), _fit(NARROW), _summary_ctes(NARROW))
        + "\nSELECT cid, lang, pct, size, median_score FROM summary",
        "q_cluster_summary_known": _with(SCORED, _vec(KNOWN_ONLY), _seed(KNOWN_ONLY), _fit(KNOWN_ONLY),
                                         _summary_ctes(KNOWN_ONLY))
        + "\nSELECT cid, lang, pct, size, median_score FROM summary",
        "q_report": _report_sql(NARROW),
    }
