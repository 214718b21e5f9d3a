"""Landing folders of polled JSON, one folder a poll day.

{path}/day=<yyyy-MM-dd>/*.json holds one payload a line.  They are read with a fixed schema; a line that is no
JSON of that schema is kept, whole, in the column _corrupt.  `days` becomes a partition filter: folders
of other days are neither listed for reading nor opened.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
LINE = "value string, day date"
#: buckets that the days are dealt to for writing; Spark joins small ones and cuts large ones at run time
DAY_BUCKETS = 512


def poll_day(poll_text: Column) -> Column:
    """The folder of a payload: the day of its poll time."""
    return F.to_date(F.substring(poll_text, 1, 10))


def dealt_by_day(lines: DataFrame) -> DataFrame:
    """`lines` (value, day), dealt to tasks by day; written as they come, each task leaves a file in the folder
    of every day that it holds.  So a day is one file; the days of a bucket that is too large for a task are
    cut among several, a file each."""
    return lines.hint("rebalance", DAY_BUCKETS, "day")


def write_landing(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Add payloads (value, day) to their days' folders."""
    lines.select("value", "day").write.mode(mode).partitionBy("day").text(path)


def read_landing(spark: SparkSession, path: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
    """The payloads of a landing folder with `day`, without corrupt lines; only those of `days`, if given."""
    return _payloads(_parsed(spark.read, path, schema, days))


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
    return _payloads(_parsed(spark.readStream, path, schema, days))


def corrupt_lines(spark: SparkSession, path: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
    """(day, value): the lines that aren't JSON of the schema."""
    return _parsed(spark.read, path, schema, days).where(f"r.{CORRUPT} is not null").select("day", F.col(f"r.{CORRUPT}").alias("value"))


def _parsed(reader, path: str, schema: T.StructType, days: Iterable[str] | None) -> DataFrame:
    """(r, day): the lines as rows of the schema; r._corrupt holds what is none."""
    lines = reader.schema(LINE).format("text").load(path)
    if days is not None:
        lines = lines.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    row = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.trim("value") != "").select(row.alias("r"), "day")


def _payloads(parsed: DataFrame) -> DataFrame:
    return parsed.where(f"r.{CORRUPT} is null").select("r.*", "day").drop(CORRUPT)
