"""Tables that cut a job's lineage, written to the shared folder named in spark.checkpoint.dir."""
from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_ROWS = 1000       # documents in one Arrow batch
#: Python workers live on between stages; so they give freed memory back instead of keeping it.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "131072", "MALLOC_TRIM_THRESHOLD_": "131072",
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package when the session was started elsewhere
    (on a cluster the package is shipped with --py-files as usual), and hold Arrow batches to BATCH_ROWS
    rows, so that a batch of long documents fits a worker's memory.  Settings that are there stay."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    if REPOSITORY not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPOSITORY, env.get("PYTHONPATH", "")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  A session on this machine alone ("local" master, as in
    tests) may leave it unset and gets a scratch folder; on a cluster an unset folder is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="wxodds-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once as Parquet to the shared folder and read back.  Lost executors then cost
    a reread, and a result that is used twice is computed once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/wxodds-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def collecting(made: list[str]) -> Iterator[None]:
    """Note the folders of all tables that are written meanwhile, for `drop`."""
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)


def drop(spark: SparkSession, made: list[str], reader: DataFrame) -> None:
    """Delete the tables noted in `made`, but for those that `reader` reads."""
    read = {f.rsplit("/", 2)[1] for f in reader.inputFiles()}
    for path in [p for p in made if p.rsplit("/", 1)[1] not in read]:
        _delete(spark, path)
        made.remove(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(df: DataFrame) -> None:
    """Let go of the shuffle files of jobs that are over.  Spark removes them once the driver has
    collected the plans that made them, which on its own may be long after a large table is written."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def remove(df: DataFrame) -> None:
    """Delete a table made by `written` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/wxodds-llm/" in folder:
            _delete(df.sparkSession, folder)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of `df` other than `names`."""
    return [c for c in df.columns if c not in names]


def schema_with(df: DataFrame, ddl: str) -> StructType:
    """The schema of `df` followed by the columns of `ddl`."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)
