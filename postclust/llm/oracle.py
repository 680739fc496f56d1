"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), item_window AS (
    SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[s:s + 12], ' ') AS w
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM b WHERE len(ws) > 0)
), doc_window AS (
    SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS w
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
          FROM d, (SELECT DISTINCT n FROM item_window) WHERE len(ws) >= n)
), found AS (
    SELECT doc_id, item_id, s, n FROM doc_window JOIN item_window USING (n, w)
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        sha256(array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',')) AS items_sha256
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ASSIGN_KEY = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                      for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({ASSIGN_KEY})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rule(kind, kind_order, pattern, value_group, least) AS (
    VALUES ('assign', 0, '{ASSIGN}', 2, 6), ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]+', 0, 24)
), matched AS (
    SELECT doc_id, kind, kind_order, least,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, '{ASSIGN}') WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+')
            ELSE regexp_extract_all(text, '[0-9a-f]+') END AS hits,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, '{ASSIGN}', 2) WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+')
            ELSE regexp_extract_all(text, '[0-9a-f]+') END AS vals,
        CASE kind WHEN 'assign' THEN string_split_regex(text, '{ASSIGN}') WHEN 'access' THEN string_split_regex(text, 'AKIA[A-Z0-9]+')
            ELSE string_split_regex(text, '[0-9a-f]+') END AS gaps
    FROM d, rule
), each AS (
    SELECT doc_id, kind, kind_order, least, unnest(range(len(hits))) AS i, length(unnest(hits)) AS n,
        length(unnest(vals)) AS n_value, length(unnest(gaps[:len(hits)])) AS n_gap FROM matched
), placed AS (
    SELECT *, sum(n_gap + n) OVER (PARTITION BY doc_id, kind ORDER BY i) - n AS start FROM each
), span AS (
    SELECT doc_id, kind, kind_order, start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS said
    FROM placed WHERE n_value >= least
), total AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(said, ',' ORDER BY start, kind_order) AS spans
    FROM span GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN total USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
    SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS m
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d WHERE len(ws) >= 50)
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p
    FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY m) AS least FROM w) WHERE doc_id > least
), word AS (
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS said FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(said, ' ' ORDER BY p) AS text
    FROM word ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
    SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
        AND len(list_filter(e, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND list_dot_product(e, e) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reached(vec_id, seen) AS (
    SELECT vec_id, vec_id FROM v
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN link l ON l.a = r.seen
), least AS (
    SELECT vec_id, min(seen) AS component_id FROM reached GROUP BY vec_id
), n AS (
    SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)
"""

LINES = r"""
WITH line AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS said, unnest(range(len(string_split(text, chr(10))))) AS line_no
    FROM documents WHERE text IS NOT NULL
), cut AS (
    SELECT doc_id, line_no, said, regexp_extract_all(said, '[^ \t\n\x0B\f\r]+') AS raw FROM line
), word AS (
    SELECT doc_id, line_no, said, raw, list_transform(raw, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS opened
    FROM cut WHERE len(raw) >= 3 OR len(regexp_extract_all(said, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]')) >= 3
), formed AS (
    SELECT doc_id, line_no, ws, len(ws) || '|' || array_to_string(branch, ' ') AS leaf, array_to_string(ws, ' ') AS form
    FROM (SELECT doc_id, line_no, CASE WHEN bare THEN raw ELSE opened END AS ws, CASE WHEN bare THEN raw ELSE opened[1:3] END AS branch
          FROM (SELECT *, len(list_filter(opened, lambda w: w <> '<*>')) = 0 AS bare FROM word))
), seen AS (
    SELECT DISTINCT doc_id, leaf, form, ws FROM formed
), own AS (
    SELECT leaf, form, min(doc_id) AS own_first FROM seen GROUP BY leaf, form HAVING count(*) >= 3
), different AS (
    SELECT DISTINCT leaf, form, ws FROM seen WHERE leaf IN (
        SELECT leaf FROM seen GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT form) > 1)
), held AS (
    SELECT leaf, place, w, count(*) AS n
    FROM (SELECT leaf, unnest(range(len(ws))) AS place, unnest(ws) AS w FROM different) GROUP BY leaf, place, w
), most AS (
    SELECT leaf, place, max(struct_pack(n := n, w := w)) AS m FROM held GROUP BY leaf, place
), constants AS (
    SELECT leaf, list(CASE WHEN m.n >= 0.7::DOUBLE * lines THEN m.w END ORDER BY place) AS cs
    FROM most JOIN (SELECT leaf, count(*) AS lines FROM different GROUP BY leaf) USING (leaf) GROUP BY leaf
), common_form AS (
    SELECT leaf, cs FROM (SELECT leaf, cs, len(list_filter(cs[4:], lambda c: c IS NOT NULL)) AS fixed FROM constants)
    WHERE fixed >= 1 AND fixed >= 0.7::DOUBLE * (len(cs) - 3) AND len(list_filter(cs, lambda c: c IS NOT NULL AND c <> '<*>')) > 0
), matched AS (
    SELECT leaf, form FROM different JOIN common_form USING (leaf)
    WHERE len(list_filter(list_zip(ws, cs), lambda p: p[2] IS NOT NULL AND p[1] <> p[2])) = 0
), shared AS (
    SELECT leaf, min(doc_id) AS common_first FROM seen JOIN matched USING (leaf, form) GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3
), run AS (
    SELECT leaf, form, p, ws[:p] || ws[p + n + 1:] AS outside
    FROM (SELECT leaf, form, ws, n, unnest(range(3, len(ws) - n + 1)) AS p
          FROM (SELECT *, (len(ws) - 3 - ceil(0.7::DOUBLE * (len(ws) - 3)))::BIGINT AS n FROM different) WHERE n >= 1)
), member AS (
    SELECT leaf, form, leaf || '|' || p || '|' || array_to_string(outside, ' ') AS template
    FROM run WHERE len(list_filter(outside, lambda w: w <> '<*>')) > 0
), several AS (
    SELECT template FROM member GROUP BY template HAVING count(*) > 1
), run_template AS (
    SELECT template, count(DISTINCT doc_id) AS docs, min(doc_id) AS first
    FROM member JOIN several USING (template) JOIN seen USING (leaf, form) GROUP BY template HAVING count(DISTINCT doc_id) >= 3
), run_form AS (
    SELECT leaf, form, arg_min(first, (-docs, first)) AS run_first FROM member JOIN run_template USING (template) GROUP BY leaf, form
), template AS (
    SELECT leaf, form, own_first, run_first, common_first
    FROM own FULL JOIN run_form USING (leaf, form) FULL JOIN (SELECT leaf, form, common_first FROM matched JOIN shared USING (leaf)) USING (leaf, form)
), dropped AS (
    SELECT doc_id, line_no FROM formed JOIN template USING (leaf, form) WHERE doc_id <> coalesce(common_first, run_first, own_first)
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(said, chr(10) ORDER BY line_no) AS text
    FROM line ANTI JOIN dropped USING (doc_id, line_no) GROUP BY doc_id
), n AS (
    SELECT doc_id, text, CASE WHEN text IS NULL OR text = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines FROM documents
), gone AS (
    SELECT doc_id, count(*) AS n_dropped FROM dropped GROUP BY doc_id
)
SELECT doc_id, n_lines::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
    CASE WHEN n_dropped IS NULL THEN n.text ELSE coalesce(kept.text, '') END AS text
FROM n LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

COPIES = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS said FROM documents
), g AS (
    SELECT said, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY said
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(said) AS text_sha256 FROM d JOIN g USING (said)
"""

AUDIT = r"""
WITH RECURSIVE said AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
), good AS (
    SELECT DISTINCT doc_id FROM labels WHERE quality = 1
), toxic AS (
    SELECT DISTINCT doc_id FROM labels WHERE toxic = 1
), doc AS (
    SELECT part,
        (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
            + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS fails,
        coalesce(doc_id IN (SELECT doc_id FROM good), false) AS is_good, coalesce(doc_id IN (SELECT doc_id FROM toxic), false) AS is_toxic
    FROM said
), cell AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (is_good) AS good, count(*) FILTER (is_toxic) AS toxic FROM doc GROUP BY part, fails
), filter_order(filter_order, before, step, name, bit) AS (
    SELECT '', 0, 0, '', 0
    UNION ALL
    SELECT o.filter_order || f.name, o.before + o.bit, o.step + 1, f.name, f.bit
    FROM filter_order o, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(name, bit) WHERE NOT contains(o.filter_order, f.name)
), step AS (
    SELECT w.filter_order, s.step, s.name, s.bit, s.before
    FROM filter_order w JOIN filter_order s ON starts_with(w.filter_order, s.filter_order) WHERE w.step = 5 AND s.step > 0
), told AS (
    SELECT part, filter_order, step, name,
        sum(n) FILTER (fails & (before | bit) = 0) AS kept,
        sum(n) FILTER (fails & before = 0 AND fails & bit > 0) AS removed,
        sum(n) FILTER (fails & before > 0 AND fails & bit > 0) AS redundant,
        sum(n) FILTER (fails = bit) AS unique_fails,
        sum(good) FILTER (fails & before = 0 AND fails & bit > 0) AS good_lost,
        sum(toxic) FILTER (fails & before = 0 AND fails & bit > 0) AS toxic_lost
    FROM cell, step GROUP BY part, filter_order, step, name
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, name))::BIGINT AS shapley
FROM told
"""

VARIANTS = r"""
WITH RECURSIVE step(i, c, k) AS (
    SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8
), run AS (
    SELECT doc_id, w, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
    WHERE length(w) >= 5 GROUP BY doc_id, w
), hashed AS (
    SELECT w, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM run, crc_table
), word AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM word)
), link AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT w.word, w.n, c.word, c.n FROM word w JOIN cut c ON w.word = c.rest
    UNION
    SELECT c.word, c.n, w.word, w.n FROM word w JOIN cut c ON w.word = c.rest
), near AS (
    SELECT word, any_value(n) AS n, count(*) AS n_near, max(other_n) AS most, min(other) FILTER (other_n = m) AS best
    FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS m FROM link) GROUP BY word
), formed AS (
    SELECT word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * word.n THEN best END AS form,
        CASE WHEN most >= 2 * word.n THEN most END AS form_n
    FROM word LEFT JOIN near USING (word)
), chain(word, root, k) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL
    SELECT chain.word, form, k + 1 FROM chain JOIN formed ON chain.root = formed.word WHERE form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word) c USING (word)
"""
