"""The corpus pipeline: what a text corpus goes through before training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in
the shared folder and rereads it as the next stage's docs.  All stages but the last return the
columns of documents; the last returns the packed pieces of what is left.

  toxicity         documents with a score of THRESHOLD or more go (no held-out label is learnt from)
  ngram_join       of each group of copies and near copies the document with the least doc_id stays;
                   of rows that repeat a doc_id and its text, one stays
  decontamination  documents that hold a twentieth or more benchmark words go
  pii              personal data is replaced by the name of its kind, and n_chars follows
  packing          the documents are tokenized, cut and packed into sequences

The operators' docstrings say how each treats nulls, empty and long texts, ties and repeated rows.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm import decontamination, ngram_join, packing, pii, toxicity
from wxodds.llm.queries_toxicity import HELD_OUT, fold
from wxodds.llm.storage import collecting, drop, load, prepare, written


def _keys(df: DataFrame) -> DataFrame:
    """What tells rows apart: doc_id (null or not) and text_key."""
    return df.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text_key")


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, each as one struct, with their keys."""
    return docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"),
                       F.xxhash64("text").alias("text_key"), F.struct("*").alias("row"))


KEYS = ["id", "none", "text_key"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    labels = load(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(labels) != HELD_OUT))
    return toxicity.scored(docs, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.components(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    heads = found.where("n > 0").groupBy("part").agg(F.min(place).alias("head")).select("head.doc_id", "head.text_key")
    heads = heads.unionAll(found.where("n = 0").select("doc_id", "text_key").distinct())
    return _keyed(docs).join(_keys(heads), KEYS).dropDuplicates(KEYS).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark"))
    bad = _keys(judged.where("contaminated")).distinct()
    return _keyed(docs).join(bad, KEYS, "left_anti").select("row.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs).drop("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: folders of the tables that each stage has written for itself
_LEFT: list[list[str]] = []


def _tidy(stage: Stage) -> Stage:
    """`stage`, which first drops the tables that the stages before it wrote for themselves: their results are
    written by then (a table that `docs` itself still reads stays)."""
    before, own = list(_LEFT), []
    _LEFT.append(own)

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for made in before:
            drop(spark, made, docs)
        with collecting(own):
            return stage(spark, docs, sf_dir)
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES = [("toxicity", _tidy(drop_toxic)), ("ngram_join", _tidy(drop_near_copies)), ("decontamination", _tidy(drop_contaminated)),
          ("pii", _tidy(redact)), ("packing", _tidy(pack))]
#: SQL can express neither the classifier nor the packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
