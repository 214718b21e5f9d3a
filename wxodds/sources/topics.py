"""Topic records: rows <-> JSON values, the wire format between the reference's jobs.

`to_records` serializes every column of a row into one JSON `value` (what a topic sink writes);
`from_records` parses values back with an explicit schema (schema-on-read with nulls for missing
or malformed fields, never inferred).  `write_topic` / `read_topic` put these records in a folder
(a file-based topic; a Kafka sink/source takes the same `value` column).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"


def to_records(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": TIMESTAMP_FORMAT}).alias("value"))


def from_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    return records.select(F.from_json("value", schema, {"timestampFormat": TIMESTAMP_FORMAT,
                                                        "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def write_topic(df: DataFrame, path: str, mode: str = "append") -> None:
    to_records(df).write.mode(mode).text(path)


def write_topic_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append a stream's rows to a topic folder, exactly once."""
    return (to_records(df).writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**trigger).start())


def parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The records as `r`, with the text of a record that is no JSON object of the schema in r._bad."""
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"timestampFormat": TIMESTAMP_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return records.select(F.from_json("value", whole, options).alias("r"))


def rows(parsed: DataFrame) -> DataFrame:
    """The records that could be parsed, as rows."""
    return parsed.where("r._bad is null").select("r.*").drop("_bad")


def read_topic(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bounded read of a topic folder from its beginning to its current end, without malformed records."""
    return rows(parsed(spark.read.text(path), schema))


def malformed_count(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """How many records of a topic folder can't be parsed (one row)."""
    return parsed(spark.read.text(path), schema).agg(F.count_if(F.col("r._bad").isNotNull()).alias("malformed"))


def read_topic_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return rows(parsed(spark.readStream.text(path), schema))
