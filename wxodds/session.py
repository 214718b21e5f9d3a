"""Session helpers: build a local session for tests/bench and pin the settings every plan relies on."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wxodds") -> SparkSession:
    """Local session used by tests and bench.py; a cluster job gets its session from spark-submit."""
    master = master or os.environ.get("WXODDS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.driver.memory", os.environ.get("WXODDS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All timestamps in the data model are UTC instants ('...Z' text at the edge)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_folder(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir.  A session on this machine alone (a local
    master, as in tests) that names none gets a scratch folder; on a cluster that is an error."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wxodds-"))
    return shared_checkpoint_dir(spark)


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; an error if the session names none, since a
    folder picked here would be local to one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured.rstrip("/")
