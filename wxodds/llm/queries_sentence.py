"""op6_sentence_spans: what sentence dedup removes from all documents; see tests/llm for the brute-force check."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.sentence_dedup import dedup
from wxodds.llm.storage import load


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.coalesce("text", F.lit(""))
    return dedup(load(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_sentences", "n_removed", F.length(kept).cast("long").alias("n_chars"), F.sha2(kept, 256).alias("kept_sha256"))
