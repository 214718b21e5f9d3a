"""op7_decontamination and its SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.decontamination import REACH, WINDOW, decontaminate
from wxodds.llm.storage import load


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                    F.size("near").cast("long").alias("n_near"))


_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
OP7_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS g FROM (
  SELECT item_id, w[i:i + {WINDOW - 1}] AS p FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM grams JOIN win USING (n, g)),
cov AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
said AS (SELECT r, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
ranked AS (SELECT g, t, row_number() OVER (PARTITION BY g ORDER BY n, t) AS k
  FROM (SELECT DISTINCT g, unnest(string_split(g, ' ')) AS t FROM win)
  JOIN (SELECT t, count(*) AS n FROM said GROUP BY t) USING (t)),
rare AS (SELECT g, max(t) FILTER (k = 1) AS t1, max(t) FILTER (k = 2) AS t2, max(t) FILTER (k = 3) AS t3
  FROM ranked GROUP BY g HAVING count(*) >= 3),
pairs AS (SELECT DISTINCT a.r, a.i, t1, t2 FROM (SELECT DISTINCT t1, t2 FROM rare) JOIN said a ON a.t = t1
  JOIN said b ON b.r = a.r AND b.t = t2 AND b.i BETWEEN a.i - {REACH} AND a.i + {REACH}),
trios AS (SELECT DISTINCT p.r, t1, t2, t3 FROM pairs p JOIN (SELECT DISTINCT t1, t2, t3 FROM rare) USING (t1, t2)
  JOIN said b ON b.r = p.r AND b.t = t3 AND b.i BETWEEN p.i - {REACH} AND p.i + {REACH}),
nears AS (SELECT r, count(DISTINCT item_id) AS n_near FROM trios JOIN rare USING (t1, t2, t3) JOIN win USING (g) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r) LEFT JOIN nears USING (r)
"""
