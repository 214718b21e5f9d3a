"""op3_packing: where each piece of each document stands; see tests/llm for the brute-force check."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxodds.llm.packing import pack, pieces
from wxodds.llm.storage import load


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(load(spark, sf_dir, "documents")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
