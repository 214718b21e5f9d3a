"""op11_collocations: each language's first phrases by their weakest cut, and the same in SQL (all phrases counted)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxodds.llm.collocations import LEAST, MOST, TOP, UNKNOWN, collocations, ranked
from wxodds.llm.storage import load


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(collocations(load(spark, sf_dir, "documents"))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
t AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
g AS (SELECT lang, w, i, unnest(range(1, {MOST} + 1)) AS s FROM t),
f AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, s, count(*) AS f FROM g WHERE i + s - 1 <= len(w)
      GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, s, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, s)) AS k FROM f WHERE s > 1),
x AS (SELECT c.lang, c.phrase, c.k, c.a, l.f AS l, r.f AS r, n.n, (1000 * c.a::HUGEINT * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.k], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1:c.s], ' ') JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT DISTINCT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, a FROM (
           SELECT lang, a, s, ws, z, unnest(range(1, s - z + 2)) AS i FROM (
             SELECT DISTINCT lang, a, s, ws, unnest(range(2, s)) AS z FROM c))),
kept AS (SELECT b.* FROM b LEFT JOIN (SELECT lang, phrase, max(a) AS a FROM held GROUP BY ALL) h USING (lang, phrase)
         WHERE h.a IS NULL OR 100 * h.a < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""
