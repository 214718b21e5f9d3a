"""Loader for the driver-generated test tables."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: bytes of files that a task is dealt: some 100,000 rows of `events`
SHARE_BYTES = 2 << 20


def shares(size: int, cores: int) -> int:
    """Among how many tasks `size` bytes of files are dealt: in proportion to the bytes, one a core at least."""
    return max(cores, math.ceil(size / SHARE_BYTES))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """`df`, dealt by `key` to tasks of a like size, so that costly parsing is neither left to a few cores nor
    to tasks that grow with the table (a file isn't split within its row groups, and splits are wide)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(shares(size, df.sparkSession.sparkContext.defaultParallelism), *key)
