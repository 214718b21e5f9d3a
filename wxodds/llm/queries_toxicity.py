"""op9_toxicity: scores of all documents by a machine that has seen no held-out label."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm import toxicity as T
from wxodds.llm.storage import load

FOLDS, HELD_OUT = 3, 1


def fold(df: DataFrame):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = T.fit(docs, labels.where(fold(labels) != HELD_OUT))
    out = T.scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(out) == HELD_OUT).alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= T.THRESHOLD).cast("int").alias("predicted"))
