"""DuckDB twins of the queries that SQL can express; each takes its own way to the rows."""

from __future__ import annotations

from fundlens.llm.licences import COPYRIGHT_LINE, KNOWN, SPELLINGS

_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP5 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM d),
grams AS (
    SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
),
lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
full_lines AS (SELECT * FROM lines WHERE regexp_matches(line, '{_WORD}')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
normal AS (
    SELECT doc_id, source, text,
        lower(regexp_replace(trim(regexp_replace(line, '{_GAP}', ' ', 'g')), '[0-9]', '0', 'g')) AS line
    FROM full_lines
),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
common AS (
    SELECT n.source, n.line FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
    GROUP BY n.source, n.line, h.docs HAVING count(DISTINCT n.text) > 10 AND count(DISTINCT n.text) * 100 > h.docs * 5
),
removed AS (
    SELECT doc_id, sum(len(string_split(n.line, ' '))) AS n FROM normal n
    JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.line = c.line GROUP BY doc_id
),
m AS (
    SELECT d.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
        length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS n_removed_words
    FROM d JOIN w USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words::BIGINT AS n_removed_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND (n_words - n_removed_words) * 100 >= n_words * 50 AS kept
FROM m
"""


def _canonical(line: str) -> str:
    words = rf"trim(regexp_replace(lower({line}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for written, canonical in SPELLINGS:
        words = f"replace({words}, {_quoted(written)}, {_quoted(canonical)})"
    return f"CASE WHEN regexp_matches(lower({line}), {_quoted(COPYRIGHT_LINE)}) THEN '' ELSE {words} END"


_JOINED = "sha256(array_to_string(list(canonical ORDER BY line_no) FILTER (canonical <> ''), ' '))"
OP3 = f"""
WITH known_text(licence, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}),
known_line AS (
    SELECT licence, text, {_canonical("line")} AS canonical, line_no
    FROM (SELECT licence, text, unnest(string_split(text, chr(10))) AS line,
        unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM known_text)
),
known AS (SELECT DISTINCT licence, {_JOINED} AS digest FROM known_line GROUP BY licence, text),
split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS line_no FROM documents
),
flat AS (SELECT doc_id, line_no, {_canonical("line")} AS canonical FROM split),
units AS (
    SELECT doc_id, 0 AS line_no, {_JOINED} AS digest FROM flat GROUP BY doc_id
    UNION ALL
    SELECT doc_id, line_no, sha256(canonical) FROM flat
    WHERE canonical <> '' AND doc_id IN (SELECT doc_id FROM flat GROUP BY doc_id HAVING count(*) > 1)
)
SELECT doc_id, line_no::BIGINT AS line_no, licence, digest FROM units JOIN known USING (digest)
"""

OP9 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, chr(10))]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], chr(10)))) END AS s
    FROM w
),
rep AS (
    SELECT min(doc_id) AS node, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
),
tok AS (SELECT node, len(s) AS n, unnest(s) AS t FROM rep),
freq AS (SELECT t, count(*) AS f FROM tok GROUP BY t),
ranked AS (SELECT node, n, t, row_number() OVER (PARTITION BY node ORDER BY f, t) AS r FROM tok JOIN freq USING (t)),
head AS (SELECT node, n, t FROM ranked WHERE r <= n - (n * 4 + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.node AS a, b.node AS b FROM head a JOIN head b ON a.t = b.t AND a.node < b.node WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
common AS (
    SELECT a, b, count(*) AS c, any_value(x.n) AS n, any_value(y.n) AS m
    FROM pairs JOIN tok x ON x.node = a JOIN tok y ON y.node = b AND y.t = x.t GROUP BY a, b
),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n + m - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, seen) AS (
    SELECT node, node FROM rep
    UNION
    SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen
),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN rep ON rep.s = list_sort(sets.s) AND len(sets.s) > 0 LEFT JOIN least USING (node)
"""

OP13 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER w <= 3
"""

ORACLES: dict[str, str] = {"op3_licences": OP3, "op5_quality_rules": OP5, "op9_jaccard": OP9, "op13_hard_negatives": OP13}
