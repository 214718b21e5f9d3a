"""op13_fill_in_middle: every document cut and put in fill-in-middle order, with digests, and the same in SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.fill_in_middle import PLAIN_FROM, SEED, SPM_BELOW, restore, transform
from wxodds.llm.storage import load


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_GROUP = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{SEED}:' || doc_id) AS h FROM documents),
g AS (SELECT *, {_GROUP.format(1)} % (n + 1) AS a, {_GROUP.format(9)} % (n + 1) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_GROUP.format(17)} % 100 >= {PLAIN_FROM} THEN 'plain'
       WHEN {_GROUP.format(25)} % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substr(t, 1, least(a, b)) AS head, substr(t, least(a, b) + 1, abs(a - b)) AS mid, substr(t, greatest(a, b) + 1) AS tail FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
         ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
