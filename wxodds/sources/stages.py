"""Stage tables of a flow: results that several jobs read, written once under a folder that the caller
names (on a cluster one that driver and executors share), reused while the input is the same, and
dropped by the caller."""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


class Stages:
    """Tables of one flow under `root`, in a sub-folder named after the flow's input."""

    def __init__(self, spark: SparkSession, root: str, source: str):
        self.spark = spark
        self.folder = f"{root.rstrip('/')}/wxodds-stages/{hashlib.sha256(source.encode()).hexdigest()[:16]}"

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as the stage `name`: written if there is no finished table of it yet, then read."""
        folder = f"{self.folder}/{name}"
        path, fs = self._path(f"{folder}/_SUCCESS")
        if not fs.exists(path):
            df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop(self) -> None:
        path, fs = self._path(self.folder)
        fs.delete(path, True)
