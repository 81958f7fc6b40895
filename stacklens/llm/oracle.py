"""DuckDB SQL of the queries that SQL can express; null where a brute-force test stands in."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"

EXACT = rf"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS i
  FROM t)
SELECT doc_id, keep_id, group_size, i = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""

_SHRUNK = """
  CASE WHEN h.{r} IS NULL THEN NULL ELSE (h.{r} + m.m_{r} * m.s_{r}) / (h.n + m.s_{r}) END"""
_STRENGTH = """
  CASE WHEN v_{r} <= m_{r} * (1 - m_{r}) / 1000001 THEN 1e6 ELSE greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1) END AS s_{r}"""
_RULES = ("short", "repeats", "symbols", "dup_lines")

QUALITY = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, [x FOR x IN regexp_split_to_array(text, '{SPACE}+') IF x <> ''] AS w,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM t),
base AS (
  SELECT rid, doc_id, source, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines
  FROM w),
lists AS (SELECT rid, [array_to_string(w[i:i + 7], ' ') FOR i IN range(1, len(w) - 6)] AS s FROM w WHERE len(w) >= 8),
pos AS (SELECT rid, md5(unnest(s)) AS s, generate_subscripts(s, 1) AS i FROM lists),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM pos),
rep AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
        FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM win WHERE n >= 2) GROUP BY rid),
b AS (SELECT base.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM base LEFT JOIN rep USING (rid)),
f AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
         n_symbols > 0.5 * n_words AS symbols, 100 * n_dup_lines > 50 * n_lines AS dup_lines
  FROM b),
h AS (
  SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {r}) AS {r}" for r in _RULES)} FROM f GROUP BY source),
m0 AS (SELECT {", ".join(f"sum({r}) / sum(n) AS m_{r}, var_pop({r} / n) AS v_{r}" for r in _RULES)} FROM h),
m AS (SELECT *, {",".join(_STRENGTH.format(r=r) for r in _RULES)} FROM m0),
v AS (
  SELECT h.source, greatest({",".join(_SHRUNK.format(r=r) for r in _RULES)}) <= 0.5 AS host_kept
  FROM h CROSS JOIN m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, short OR repeats AS base_failed,
       host_kept, NOT (short OR repeats) AND host_kept AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


FILL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
k AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k),
p AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:n], '') AS suffix
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": EXACT, "op4_quality_rules": QUALITY, "op12_fill_in_middle": FILL}
