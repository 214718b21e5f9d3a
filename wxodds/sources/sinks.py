"""Serving-table sinks.

`*_rows` narrow a stream to the table's types (the SQL store's NUMERIC/SMALLINT/INTEGER columns);
`write_batch` appends one micro-batch idempotently: rows are written under batch_id=<id>, and a
replayed batch overwrites its own folder instead of adding duplicates.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.schemas import ACCURACY_TABLE, ALERTS_TABLE, CORRELATIONS_TABLE

CORR_SOURCE = {
    "location_name": "LOCATION_NAME", "actual_outcome": "ACTUAL_OUTCOME",
    "prediction_error": "PREDICTION_ERROR", "correlation_latency_sec": "CORRELATION_LATENCY_SEC",
    "poll_timestamp": "POLL_TIMESTAMP",
}
ACC_SOURCE = {"location_name": "LOCATION_NAME"}
ALERT_SOURCE = {"location_name": "LOCATION_NAME", "poll_timestamp": "POLL_TIMESTAMP",
                "alert_timestamp": "ALERT_TIMESTAMP"}

# natural keys used to make appends idempotent
CORRELATIONS_KEY = ["condition_id", "poll_timestamp", "data_type"]
ACCURACY_KEY = ["location_name", "window_start"]
ALERTS_KEY = ["alert_type", "location_name", "condition_id", "poll_timestamp"]


def table_schema_cast(df: DataFrame, table: list[tuple[str, str]], source: dict[str, str],
                      inserted_at: Column) -> DataFrame:
    """Project and narrow to the table types.  Rows with a value that doesn't fit its column are left out;
    `misfits` returns them, so that none is lost or silently changed."""
    cols = [F.col(source.get(n, n)).try_cast(t).alias(n) for n, t in table]
    return df.where(~_misfit(table, source)).select(*cols, inserted_at.alias("inserted_at"))


def _misfit(table: list[tuple[str, str]], source: dict[str, str]) -> Column:
    """Whether some value is lost by the cast to its column's type."""
    lost = F.lit(False)
    for n, t in table:
        c = F.col(source.get(n, n))
        lost = lost | (c.isNotNull() & c.try_cast(t).isNull())
    return lost


def misfits(df: DataFrame, table: list[tuple[str, str]], source: dict[str, str]) -> DataFrame:
    """The rows that `table_schema_cast` leaves out, as they are."""
    return df.where(_misfit(table, source))


def correlations_rows(corr: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    return table_schema_cast(corr, CORRELATIONS_TABLE, CORR_SOURCE,
                             F.col("POLL_TIMESTAMP") if inserted_at is None else inserted_at)


def accuracy_rows(acc: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    return table_schema_cast(acc, ACCURACY_TABLE, ACC_SOURCE,
                             F.col("window_end") if inserted_at is None else inserted_at)


def alerts_rows(alerts: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    return table_schema_cast(alerts, ALERTS_TABLE, ALERT_SOURCE,
                             F.col("ALERT_TIMESTAMP") if inserted_at is None else inserted_at)


def write_batch(rows: DataFrame, path: str, batch_id: int, key: list[str], time: str | None = None) -> None:
    """Idempotent micro-batch append (use from foreachBatch).  Rows are unique on the natural key within
    the batch and, with `time` (a column that rows of one key share), across batches: keys of earlier
    batches since the batch's first time are read and left out.  A replayed batch overwrites its folder."""
    spark = rows.sparkSession
    rows = rows.dropDuplicates(key)
    if time:
        rows = rows.persist()
        first = rows.agg(F.min(time)).first()[0]
        if first is not None and batch_id > 0 and _exists(spark, path):
            before = spark.read.parquet(path).where((F.col("batch_id") != batch_id) & (F.col(time) >= F.lit(first)))
            same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
            left = rows.alias("r").join(before.select(*key).alias("b"), same, "left_anti")
        else:
            left = rows
    else:
        left = rows
    (left.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    if time:
        rows.unpersist()


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
