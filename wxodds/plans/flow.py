"""The batch flow over one folder of test tables.

    events -> raw market polls -> pred ┐
    events -> raw weather polls -> wx  ┴-> corr -> acc -> alerts -> serving tables

Plans are lazy: building a query starts no job and writes nothing.  The flow's topics (shaped, wx, pred, corr,
acc), which several branches of a query read, are marked to be kept in executors' memory and disk as
the query first computes them; so the raw input is parsed once for a query, not once for a branch, and what
a lost executor held is computed again.  `release` lets go of them (registered queries do so when their
result is dropped).  A caller that runs several queries over one input names a shared folder
(`stage_dir`) instead; then the topics are written there once, reused by every later flow over the same
input, and dropped by `drop_stages`.
"""
from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from wxodds.operators import accuracy, anomaly, correlate, ingest
from wxodds.session import pin_utc
from wxodds.sources import fixtures, sinks, stages


def release(held: list[DataFrame]) -> None:
    """Let go of what a flow keeps."""
    while held:
        held.pop().unpersist()


class Flow:
    def __init__(self, spark: SparkSession, sf_dir: str, stage_dir: str | None = None):
        pin_utc(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.stages = stages.Stages(spark, stage_dir, sf_dir) if stage_dir else None
        self.held: list[DataFrame] = []

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.stages.table(df, name) if self.stages else self._hold(df)

    def _hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def release(self) -> None:
        release(self.held)

    def drop_stages(self) -> None:
        if self.stages:
            self.stages.drop()

    @cached_property
    def raw_events(self) -> DataFrame:
        return fixtures.raw_events(self.spark, self.sf_dir)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return fixtures.raw_weather(self.spark, self.sf_dir)

    @cached_property
    def shaped(self) -> DataFrame:
        return self._stage(ingest.shaped_predictions(self.raw_events), "shaped")

    @cached_property
    def pred(self) -> DataFrame:
        return self._stage(ingest.published_predictions(self.shaped), "pred")

    @cached_property
    def wx(self) -> DataFrame:
        wx = ingest.observations(self.raw_weather)
        return wx if self.stages else self._hold(wx)

    @cached_property
    def geo(self) -> DataFrame:
        return fixtures.geo_dim(self.spark)

    @cached_property
    def corr_ext(self) -> DataFrame:
        return self._stage(correlate.correlate(self.pred, self.wx, keep_extra=True), "corr")

    @cached_property
    def corr(self) -> DataFrame:
        return correlate.shape_correlation(self.corr_ext)

    @cached_property
    def acc(self) -> DataFrame:
        return self._stage(accuracy.accuracy_sliding(self.corr), "acc")

    @cached_property
    def alerts(self) -> DataFrame:
        return anomaly.alerts_all(self.acc, self.corr)

    # serving tables (sink projections; inserted_at = event time for repeatable panels)
    @cached_property
    def correlations_table(self) -> DataFrame:
        return sinks.correlations_rows(self.corr)

    @cached_property
    def accuracy_table(self) -> DataFrame:
        return sinks.accuracy_rows(self.acc)

    @cached_property
    def alerts_table(self) -> DataFrame:
        return sinks.alerts_rows(self.alerts)
