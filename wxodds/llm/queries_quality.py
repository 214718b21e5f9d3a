"""op4_quality_rules and its SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxodds.llm import quality_rules as Q
from wxodds.llm.storage import load, written

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = written(Q.judge(Q.measure(load(spark, sf_dir, "documents"))), "op4")
    return Q.apply_rules(judged).select(*COLUMNS)


def _shrunk(rule: str) -> str:
    return f"""(sum(CAST({rule} AS INT)) + any_value(m_{rule}) * any_value(s_{rule})) / (count(*) + any_value(s_{rule}))"""


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (
  SELECT r, i, array_to_string(w[i:i + {Q.WINDOW - 1}], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {Q.WINDOW - 2})) AS i FROM w WHERE len(w) >= {Q.WINDOW})),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {Q.WINDOW})) AS p FROM rep) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines
  FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN lines USING (r)),
j AS (
  SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    100 * n_symbols > {Q.MAX_SYMBOL_PERCENT} * n_words AS symbols_failed,
    100 * n_dup_lines > {Q.MAX_DUP_LINE_PERCENT} * n_lines AS lines_failed FROM m),
rates AS (SELECT source, {', '.join(f'avg(CAST({r} AS INT)) AS q_{r}' for r in Q.RULES)} FROM j GROUP BY source),
mv AS (SELECT {', '.join(f'avg(q_{r}) AS m_{r}, var_pop(q_{r}) AS v_{r}' for r in Q.RULES)} FROM rates),
prior AS (SELECT *, {', '.join(f'CASE WHEN v_{r} > 0 THEN least(1000.0, greatest(1.0, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE 1000.0 END AS s_{r}' for r in Q.RULES)} FROM mv),
hosts AS (SELECT source, greatest({', '.join(_shrunk(r) for r in Q.RULES)}) > {Q.MAX_HOST_RATE} AS rejected
  FROM j, prior GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM j JOIN hosts ON j.source IS NOT DISTINCT FROM hosts.source
"""
