"""Substring dedup by sliding sentence spans.

For each sentence, the shortest run of consecutive sentences that ends with it, holds SPAN sentences
at least and SPAN_WORDS words at least, is hashed, and so is the shortest such run that starts with
it; a sentence of LONE_WORDS words or more is also a run of its own.  Runs are joined over the whole
corpus by their 128-bit hashes, and a sentence that is covered by any run but the first of its hash is
removed.  A passage of SPAN sentences and SPAN_WORDS words or more holds, for each of its sentences,
one of these runs that covers it, so the result is that of hashing all runs of any length: a passage
that repeats keeps its first occurrence alone, however its sentences are divided; a passage under
SPAN_WORDS words is left alone.

A sentence ends after . ! or ? and white space, or at a line break; its words are what stands between
white space, compared in lower case.  The first occurrence is the one with the least (doc_id,
text_key, sentence number).  Defined results: a null text has no sentences and stays null; a null
doc_id comes first; rows that repeat both doc_id and text are treated alike, as one; texts of any
length are read whole; an empty table gives an empty result; `dedup` leaves other columns as they are.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxodds.llm.storage import written

SPAN, SPAN_WORDS, LONE_WORDS = 2, 13, 25
KEY = ("doc_id", "text_key")
_END = re.compile(r"[.!?]+\s+|\s*\n\s*")


def sentences(text: str) -> list[tuple[int, int]]:
    """[start, end) of the sentences with what separates them from the next; they cover the text."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    starts = [0, *ends]
    return [(a, b) for a, b in zip(starts, ends, strict=False) if a < b]


def runs(text: str) -> Iterator[tuple[bytes, int, int]]:
    """(digest, last sentence, sentences) of each run."""
    parts = [text[a:b].lower().split() for a, b in sentences(text)]
    joined = [" ".join(p) for p in parts]
    counts = [len(p) for p in parts]
    for k, n in enumerate(counts):
        if n >= LONE_WORDS:
            yield xxhash.xxh3_128_digest(joined[k]), k, 1
        first, words = k, n
        while first > 0 and (k - first + 1 < SPAN or words < SPAN_WORDS):
            first -= 1
            words += counts[first]
        if n and k - first + 1 >= SPAN and words >= SPAN_WORDS:
            yield xxhash.xxh3_128_digest("\n".join(joined[first:k + 1])), k, k - first + 1
    last, words = -1, 0
    for k, n in enumerate(counts):               # words: those of sentences k to last
        while last + 1 < len(counts) and (last - k + 1 < SPAN or words < SPAN_WORDS):
            last += 1
            words += counts[last]
        if last - k + 1 < SPAN or words < SPAN_WORDS:
            break
        if n and last - k >= SPAN and words - n >= SPAN_WORDS:      # else it is the one that ends with `last`
            yield xxhash.xxh3_128_digest("\n".join(joined[k:last + 1])), last, last - k + 1
        words -= n


_RUNS = "doc_id long, text_key long, a long, b long, last int, size int"


def run_rows(docs: DataFrame) -> DataFrame:
    """The runs of `docs` (doc_id, text_key, text); a and b are the digest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                own = [list(runs(t or "")) for t in part["text"]]
                count = [len(x) for x in own]
                digest = np.frombuffer(b"".join(d for x in own for d, _, _ in x), np.int64).reshape(-1, 2)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64").repeat(count).array, "text_key": np.repeat(part["text_key"].to_numpy(), count),
                    "a": digest[:, 0], "b": digest[:, 1],
                    "last": np.array([k for x in own for _, k, _ in x], np.int32),
                    "size": np.array([n for x in own for _, _, n in x], np.int32)})

    return docs.select(*KEY, "text").mapInPandas(run, _RUNS)


def covered(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and `gone`, the numbers of the sentences to remove, for documents that have any."""
    rows = written(run_rows(docs), "runs")
    place = F.struct("doc_id", "text_key", "last")
    twice = rows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    twice = twice.where("n > 1").select("a", "b", "first")
    later = rows.join(twice, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    numbers = later.select(*KEY, F.explode(F.sequence(F.col("last") - F.col("size") + 1, F.col("last"))).alias("k"))
    return numbers.groupBy(*KEY).agg(F.collect_set("k").alias("gone"))


def dedup(docs: DataFrame) -> DataFrame:
    """`docs` with its texts shortened, and n_sentences and n_removed (which replace columns so named)."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.struct("*").alias("row"))
    gone = covered(keyed.drop("row")).withColumnsRenamed({k: f"g_{k}" for k in KEY})
    same = F.col("doc_id").eqNullSafe(F.col("g_doc_id")) & (F.col("text_key") == F.col("g_text_key"))
    joined = keyed.join(gone, same, "left").select("row", "text", "gone")

    @F.pandas_udf("text string, n_sentences long, n_removed long")
    def shorten(texts: pd.Series, gone_: pd.Series) -> pd.DataFrame:
        out = []
        for text, numbers in zip(texts, gone_, strict=True):
            cut = sentences(text or "")
            drop = set() if numbers is None else set(numbers.tolist())
            kept = text if not drop else "".join(text[a:b] for k, (a, b) in enumerate(cut) if k not in drop)
            out.append((kept, len(cut), len(drop)))
        return pd.DataFrame(out, columns=["text", "n_sentences", "n_removed"])

    made = ("text", "n_sentences", "n_removed")
    return joined.select("row", shorten("text", "gone").alias("made")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in made[1:] and c != "text"], *[F.col("made")[c].alias(c) for c in made])
