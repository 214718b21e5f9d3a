"""op12_minhash_dedup: sizes and components of all documents, and the same in SQL (all shared shingles counted)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.minhash_join import PERCENT, SHINGLE, components
from wxodds.llm.storage import load


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(load(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')")
OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) GROUP BY a.doc_id, b.doc_id),
links AS (SELECT p.x, p.y FROM pairs p JOIN n nx ON nx.doc_id = p.x JOIN n ny ON ny.doc_id = p.y
  WHERE 100 * p.c >= {PERCENT} * (nx.n + ny.n - p.c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x),
o AS (SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, doc_id = component_id AS kept FROM o
"""
