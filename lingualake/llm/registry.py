"""What this subpackage adds to the driver contract."""

from __future__ import annotations

from . import queries_text as q


def queries() -> dict:
    return {
        "op1_pii": q.op1_pii,
        "op2_quality_rules": q.op2_quality_rules,
        "op3_quality_classifier": q.op3_quality_classifier,
        "op4_mixing": q.op4_mixing,
        "op5_ngram_jaccard": q.op5_ngram_jaccard,
        "op6_html": q.op6_html,
        "op7_licenses": q.op7_licenses,
        "op8_packing": q.op8_packing,
        "op9_secrets": q.op9_secrets,
        "op10_caps": q.op10_caps,
        "op11_winnowing": q.op11_winnowing,
        "op12_alignment": q.op12_alignment,
        "op13_periodic_runs": q.op13_periodic_runs,
    }


#: Windows of ten words, or an item's all; documents and items by words in lower case.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_AT = "unnest(list_transform(range(1, len(w) - m + 2), lambda p: {'p': p, 's': array_to_string(w[p:p + m - 1], ' ')}))"
_WINNOWING = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, w, least(len(w), 10) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, m, x.s FROM (SELECT item_id, m, {_AT} AS x FROM i)),
dw AS (SELECT doc_id, m, x.p, x.s FROM (SELECT doc_id, m, {_AT} AS x FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hit AS (SELECT doc_id, p, m, item_id FROM dw JOIN iw USING (m, s)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


#: Smallest id that links lead to, by the closure of link (x, y), each pair both ways.
_REACH = "reach AS (SELECT id, id AS z FROM node UNION SELECT r.id, l.y FROM reach r JOIN link l ON l.x = r.z), least_of AS (SELECT id, min(z) AS component_id FROM reach GROUP BY 1)"
_JACCARD = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), sn AS (SELECT doc_id, g, n FROM s JOIN n USING (doc_id)),
one AS (SELECT a.doc_id AS x, b.doc_id AS y FROM sn a JOIN sn b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
link AS (SELECT x, y FROM one UNION ALL SELECT y, x FROM one), node AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN least_of ON id = d.doc_id"""
_CAPS = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM v WHERE len(list_filter(e, lambda t: t IS NULL OR NOT isfinite(t))) = 0 AND len(e) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.len > 0 AND b.len > 0 AND list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.9),
links AS (SELECT x, count(*) AS n FROM link GROUP BY 1), node AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings LEFT JOIN links ON x = vec_id JOIN least_of ON id = vec_id"""
#: crc32 of a text of digits, bit by bit.
_CRC = "xor(list_reduce(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda k: CAST(ascii(CAST(doc_id AS VARCHAR)[k]) AS BIGINT)), lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
#: Islands of equal words q apart; of those over the same words the least q is the run's period.
_PERIODS = rf"""WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC} AS h FROM documents),
g AS (SELECT *, len(w) AS n, h // 10 AS g FROM h), a AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM g),
d AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM a),
pos AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM d),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM pos x JOIN pos y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
island AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same) GROUP BY doc_id, q, k),
run AS (SELECT doc_id, start, length, min(q) AS q FROM island WHERE length >= greatest(12, 2 * q) GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, q) AS k FROM run),
runs AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS said FROM run GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.q AS period, 1000 * best.length // best.q AS exponent_milli, sha256(coalesce(runs.said, '')) AS runs_sha256, sha256(coalesce(left_.said, '')) AS collapsed_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN best ON best.doc_id = d.doc_id AND best.k = 1 LEFT JOIN left_ ON left_.doc_id = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op5_ngram_jaccard": _JACCARD, "op10_caps": _CAPS, "op11_winnowing": _WINNOWING, "op13_periodic_runs": _PERIODS}
