"""One stream over all result topics, dealt out by topic to the serving tables.

Topics are folders {root}/topic=<name> of JSON records.  Each micro-batch is read once; each topic's records
are parsed with its schema, narrowed to its table's types and merged into the table by its natural key
(upsert.py).  What doesn't fit goes to {out}/quarantine with the topic and the reason: records that are no
JSON of the schema, rows with a value that the table can't hold, records of topics without a table.
"""
from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wxodds import schemas
from wxodds.sources import sinks, topics
from wxodds.sources.upsert import upsert

QUARANTINE = "topic string, reason string, value string"
SPAN = "month"      # of a bucket: the feeds' polls are some thousands a day


class Table(NamedTuple):
    schema: T.StructType
    types: list[tuple[str, str]]
    source: dict[str, str]
    rows: Callable[[DataFrame], DataFrame]
    key: list[str]
    time: str


TABLES = {
    "correlations": Table(schemas.CORR, schemas.CORRELATIONS_TABLE, sinks.CORR_SOURCE, sinks.correlations_rows,
                          sinks.CORRELATIONS_KEY, "poll_timestamp"),
    "accuracy": Table(schemas.ACC, schemas.ACCURACY_TABLE, sinks.ACC_SOURCE, sinks.accuracy_rows, sinks.ACCURACY_KEY, "window_start"),
    "alerts": Table(schemas.ALERT, schemas.ALERTS_TABLE, sinks.ALERT_SOURCE, sinks.alerts_rows, sinks.ALERTS_KEY, "poll_timestamp"),
}


def topic_folder(root: str, topic: str) -> str:
    return f"{root}/topic={topic}"


def with_topic(records: DataFrame) -> DataFrame:
    """(topic, value) of text records read from topic folders."""
    return records.select(F.regexp_extract("_metadata.file_path", "/topic=([^/]+)/", 1).alias("topic"), "value")


def read_topics(spark: SparkSession, root: str) -> DataFrame:
    return with_topic(spark.read.text(f"{root}/topic=*"))


def read_topics_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_topic(r.text(f"{root}/topic=*"))


def route(batch: DataFrame, batch_id: int, out: str) -> None:
    """Deal one micro-batch (topic, value) out to the tables; replaying it changes nothing."""
    batch = batch.persist()
    try:
        bad = [batch.where(~F.col("topic").isin(*TABLES)).select("topic", F.lit("topic").alias("reason"), "value")]
        for name, table in TABLES.items():
            parsed = topics.parsed(batch.where(F.col("topic") == name), table.schema)
            rows = topics.rows(parsed)
            upsert(table.rows(rows), f"{out}/{name}", table.key, table.time, span=SPAN)
            misfit = topics.to_records(sinks.misfits(rows, table.types, table.source))
            for reason, records in (("record", parsed.where("r._bad is not null").select(F.col("r._bad").alias("value"))), ("value", misfit)):
                bad.append(records.select(F.lit(name).alias("topic"), F.lit(reason).alias("reason"), "value"))
        rest = bad[0]
        for df in bad[1:]:
            rest = rest.unionByName(df)
        # a batch without misfits makes no folder
        (rest.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{out}/quarantine"))
    finally:
        batch.unpersist()


def start_routing(topics_root: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (topics_root.writeStream.foreachBatch(lambda batch, batch_id: route(batch, batch_id, out))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
