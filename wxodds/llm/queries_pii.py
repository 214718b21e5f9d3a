"""op8_pii: counts and digests of the spans.  SQL can't give positions of matches; see tests/llm."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm import pii
from wxodds.llm.storage import load


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(load(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
