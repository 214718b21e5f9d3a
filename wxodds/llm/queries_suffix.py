"""op5_suffix_dedup: digests of what remains of all documents; SQL has no byte strings of texts, see tests/llm."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxodds.llm.storage import load
from wxodds.llm.suffix_dedup import dedup


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(load(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
