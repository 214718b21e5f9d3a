"""Serving tables that micro-batches are merged into by natural key.

Layout: {path}/day=<day>/part=<hash of the key>/version=<n>.  A batch reads the newest version of the
(day, part) buckets that its rows fall into, and nothing else; it writes these buckets anew as one higher
version and drops versions older than the one it read.  So a batch costs what its own days hold, however
many went before, a bucket holds two folders at most, and readers of the former version aren't disturbed.
A table whose days hold few rows keeps a month in a bucket (`span`), named by the month's first day: each
bucket costs some file operations in the driver and a file a batch, whatever it holds.

A row replaces the one of its key, so a replayed batch or a redelivered row leaves one row.  A run that
breaks off leaves each bucket at its old or its new version; replaying the batch makes all of them new.
(Version folders are moved into place whole, as file systems with a rename do.)
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = 4
BUCKET = ["day", "part"]
NO_DAY = "0001-01-01"        # of rows without a time


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in `path`; none if there is no such path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _drop(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def versions(spark: SparkSession, path: str, day, part) -> list[int]:
    """The versions of a bucket, oldest first."""
    names = _folders(spark, f"{path}/day={day}/part={part}")
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def _bucketed(rows: DataFrame, key: list[str], time: str, parts: int, span: str) -> DataFrame:
    day = F.coalesce(F.date_format(F.date_trunc(span, time), "yyyy-MM-dd"), F.lit(NO_DAY))
    return rows.withColumns({"day": day, "part": F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")})


def _read(spark: SparkSession, path: str, schema: T.StructType, newest: dict[tuple[str, int], int]) -> DataFrame:
    """The rows of these versions of buckets, with the bucket's columns."""
    whole = T.StructType([*schema.fields, T.StructField("day", T.StringType()), T.StructField("part", T.IntegerType())])
    paths = [f"{path}/day={d}/part={p}/version={v}" for (d, p), v in newest.items()]
    if not paths:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*paths).select(*whole.names)


def upsert(rows: DataFrame, path: str, key: list[str], time: str, parts: int = PARTS, span: str = "day") -> None:
    """Merge `rows` into the table at `path`.  `time` is a column that rows of one key share; its day (or the
    first day of its `span`) and a hash of the key name the bucket; `parts` and `span` are the same for all
    batches of a table.  Of rows of one batch with one key the greatest stays."""
    spark, schema = rows.sparkSession, rows.schema
    batch = _bucketed(rows, key, time, parts, span).persist()
    try:
        buckets = [(r["day"], r["part"]) for r in batch.select(*BUCKET).distinct().collect()]     # of this batch alone
        had = {b: versions(spark, path, *b) for b in buckets}
        before = _read(spark, path, schema, {b: v[-1] for b, v in had.items() if v})
        rest = F.struct(*[c for c in schema.names if c not in key])
        both = before.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
        merged = (both.repartition(*BUCKET).groupBy(*BUCKET, *key).agg(F.max(F.struct("_new", rest.alias("row"))).alias("best"))
                  .select(*key, "best.row.*", *BUCKET).select(*schema.names, *BUCKET))
        version = 1 + max((v[-1] for v in had.values() if v), default=-1)
        if buckets:
            (merged.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*BUCKET, "version").parquet(path))
        for (day, part), old in had.items():
            for v in old[:-1]:
                _drop(spark, f"{path}/day={day}/part={part}/version={v}")
    finally:
        batch.unpersist()


def read_table(spark: SparkSession, path: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
    """The table as it stands (the newest version of each bucket), or the given days of it (of months: their first days)."""
    names = _folders(spark, path) if days is None else [f"day={d}" for d in days]
    newest = {}
    for day in (n.removeprefix("day=") for n in names if n.startswith("day=")):
        for part in (int(n.removeprefix("part=")) for n in _folders(spark, f"{path}/day={day}")):
            if found := versions(spark, path, day, part):
                newest[day, part] = found[-1]
    return _read(spark, path, schema, newest).drop(*BUCKET)
