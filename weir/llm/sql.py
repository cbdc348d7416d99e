"""DuckDB SQL for the operators that SQL can express."""

_OP6 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), active AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (a.k IS NOT NULL AND l.doc_id <> a.keeper))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (a.k IS NULL OR l.doc_id = a.keeper), ''))
         AS kept_sha256
FROM keyed l LEFT JOIN active a ON l.k = a.k
GROUP BY l.doc_id
"""

_OP8 = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), grams AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep FROM (
    SELECT g.doc_id, unnest(generate_series(g.i, g.i + 4)) AS p
    FROM grams g JOIN (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1) d ON g.doc_id = d.doc_id AND g.g = d.g)
  GROUP BY doc_id
), c AS (
  SELECT w.doc_id, w.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(n_rep, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM w LEFT JOIN lines ON w.doc_id = lines.doc_id LEFT JOIN repeated ON w.doc_id = repeated.doc_id
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * n_lines AS weak_failed FROM c
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(CASE WHEN base_failed OR weak_failed THEN 1 ELSE 0 END)::DOUBLE AS f
  FROM b WHERE source IS NOT NULL GROUP BY source
), s AS (
  SELECT count(*) AS k, sum(n) AS n, sum(f) AS f, sum(f) / sum(n) AS m, sum(f * f / n) AS q, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room FROM h
), r AS (
  SELECT *, CASE WHEN f > 0 AND f < n AND room > 0
    THEN least(greatest(((q - n * m * m) / (m * (1 - m)) - (k - 1)) / room, 1e-4), 0.99) END AS rho FROM s
), p AS (
  SELECT coalesce(m * (1 / rho - 1), 1) AS alpha, coalesce((1 - m) * (1 / rho - 1), 1) AS beta FROM r
), v AS (
  SELECT source, a / (a + z) AS rate, a / (a + z) - 2 * sqrt(a * z / ((a + z) * (a + z) * (a + z + 1))) AS low
  FROM (SELECT source, n, f + alpha AS a, n - f + beta AS z FROM h, p)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR coalesce(low > 0.5, false) OR weak_failed AND coalesce(rate, alpha / (alpha + beta)) >= 0.05) AS kept
FROM b LEFT JOIN v ON b.source = v.source CROSS JOIN p
"""

_OP10 = r"""
WITH norm AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM windows
), grams AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM norm, lengths WHERE len(w) >= n)
), matches AS (
  SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.win = x.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM matches)
  GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM matches) GROUP BY doc_id
)
SELECT n.doc_id, len(n.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(f.n_items, 0)::BIGINT AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM norm n LEFT JOIN hit h ON n.doc_id = h.doc_id LEFT JOIN found f ON n.doc_id = f.doc_id
"""

ORACLE = {"op6_line_dedup": _OP6, "op8_quality_rules": _OP8, "op10_decontamination": _OP10}
