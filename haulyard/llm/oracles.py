"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NAME_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK_WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op1_decontaminate"] = f"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({LOWER.format("text")}, '{NAME_WORD}') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), doc AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '{NAME_WORD}') AS w FROM documents
), gram AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS u(i)
), found AS (
  SELECT doc_id, g.n, i, item FROM gram g JOIN win USING (n, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM found GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op5_mixing"] = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{BLANK_WORD}')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('5:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM doc GROUP BY source
), fill AS (
  -- shares by weight; sources above three times their size are set to that, and the rest shared anew
  SELECT 0 AS step, [CAST(NULL AS STRUCT(s VARCHAR, lim BIGINT, w INTEGER))] AS done
  UNION ALL
  SELECT step + 1, (SELECT list({{'s': coalesce('=' || source, 'null'), 'lim': 3 * source_size, 'w': w}})
                    FROM src, (SELECT sum(source_size) AS t FROM src),
                         (SELECT coalesce(sum(x.lim), 0) AS lim, coalesce(sum(x.w), 0) AS gone FROM unnest(done) AS q(x) WHERE x.s IS NOT NULL),
                         (SELECT sum(w) AS every FROM src)
                    WHERE 3 * source_size * (every - gone) <= (t - lim) * w
                       OR coalesce('=' || source, 'null') IN (SELECT x.s FROM unnest(done) AS q(x)))
  FROM fill WHERE step < 40
), last AS (
  SELECT x FROM (SELECT unnest(coalesce(done, [])) AS x FROM fill WHERE step = 40) WHERE x IS NOT NULL
), target AS (
  SELECT source, source_size, CAST(CASE WHEN x.s IS NOT NULL THEN 3 * source_size
         ELSE CAST((SELECT sum(source_size) FROM src) - (SELECT coalesce(sum(x.lim), 0) FROM last) AS DOUBLE) * w
              / ((SELECT sum(w) FROM src) - (SELECT coalesce(sum(x.w), 0) FROM last)) END AS DOUBLE) AS target
  FROM src LEFT JOIN last ON x.s = coalesce('=' || source, 'null')
), rated AS (
  SELECT doc.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS expected
  FROM doc JOIN target ON doc.source IS NOT DISTINCT FROM target.source
), placed AS (
  SELECT *, CAST(floor(expected) AS BIGINT) AS whole, expected - floor(expected) AS p FROM rated
), ranked AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q, target - whole * source_size AS wanted FROM placed
), cut AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked
), taken AS (
  SELECT *, whole + CASE WHEN q IS NOT NULL AND wanted > 0 AND upto - size / 2.0 <= wanted THEN 1 ELSE 0 END AS copies FROM cut
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM taken
"""

ORACLES["op7_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(role) + length(text) + (length(role || text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '>', ''))) AS written FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS read,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(written + length('<turn >') + length('</turn>') + 1) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(read) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
