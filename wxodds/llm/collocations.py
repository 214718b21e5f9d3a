"""Collocations by count streams in prefix and suffix order that are merge-joined in lockstep.

Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces and those at blanks and tabs into
words; all is counted by `lang` (null: `und`).  f(phrase) counts its contiguous occurrences within
pieces, overlaps included; n counts all words.  Candidates are phrases of 2 to MOST words with
a = f(phrase) >= LEAST.  A cut of a candidate after k words has l = f(first part), r = f(rest) and the
score floor(1000 * a * n / (l * r)); the lowest-scoring cut counts, of equal scores that with the
smallest k.  A candidate that stands inside a longer one with the same count is dropped.

  sieve    A phrase can reach LEAST only if each of its word pairs does.  Pairs are counted by 64-bit
           hashes, and those that reach LEAST are marked in a Bloom filter of 2^SIEVE_BITS bits, whatever
           the input's size.  It lets others pass, too (more, the fuller it is), but stops none that counts.
  counts   Each task counts the phrases of up to MOST words that pass, in runs of RUN words, and Spark adds
           the runs up.  Phrases with a count of LEAST or more stay, and the empty phrase, whose count is n.
  streams  The counts are written twice: dealt by range and sorted by their words (prefix order), and by
           their words from the last to the first (suffix order).  A cut asks the first stream for its first
           part and the second for its rest.
  merges   Askers and counts go to the same ranges of (lang, key, share) and are sorted, each count ahead of
           those that ask for it, and one pass carries the count along: a merge join without hash tables.
           An often asked key has its count copied to SHARES shares.  Its extensions by one word are
           askers of a key, too: if one has the same count, the key is dropped.  (If a longer phrase that
           holds the key has its count, so has one that is longer by one word.)

Arithmetic is exact: counts are long, products decimal(38), divisions whole.  Defined results: a null or
empty text has no words; rows that repeat a doc_id each count; ties end with the phrase in UTF-8 byte
order; texts of any length are read whole; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxodds.llm.storage import remove, written

MOST, LEAST, TOP = 5, 100, 2000
SIEVE_BITS, SIEVE_HASHES = 27, 3      # 16 MB; 3 bits a pair
RUN = 4_000_000                       # words counted at once in a task
SHARES = 16
UNKNOWN = "und"

_END = b"\xff"                        # no byte of UTF-8; a word of its own between pieces
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- runs of words --------------------------------------------------------------------------------

def words(text: str) -> list[bytes]:
    """The words of a text, with _END after each piece."""
    return (text.encode().translate(_FOLD).replace(_END, b" " + _END + b" ") + b" " + _END).split()


class Words(dict):
    """Numbers for words in order of their first use; _END is 0."""
    def __init__(self) -> None:
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_runs(batches: Iterator[pd.DataFrame], run: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, codes): the words of documents of one language, as numbers; all runs together have all."""
    vocabulary, held, size = Words(), {}, 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            found = words(text) if text else []
            if len(found) > 1:
                held.setdefault(lang, []).append(np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found)))
                size += len(found)
            if size > run:
                names = list(vocabulary)
                yield from ((lang, names, np.concatenate(codes)) for lang, codes in held.items())
                vocabulary, held, size = Words(), {}, 0
    names = list(vocabulary)
    yield from ((lang, names, np.concatenate(codes)) for lang, codes in held.items())


def pair_hashes(lang: str, names: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two words of one piece follow each other, and a hash of each such pair and its language."""
    at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
    h = (own[codes[at]] * _ODD + own[codes[at + 1]]) ^ np.uint64(xxhash.xxh3_64_intdigest(lang))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return at, h ^ (h >> np.uint64(29))


# ---- the sieve ------------------------------------------------------------------------------------

def _places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bits of a pair in a sieve of `size` bits, a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.uint64(k) * step) & np.uint64(size - 1) for k in range(SIEVE_HASHES))


def sieve(docs: DataFrame, least: int, size: int, run: int) -> np.ndarray:
    """The bits of all word pairs that occur `least` times or more, 64 to a number."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, names, codes in word_runs(batches, run):
            h, c = np.unique(pair_hashes(lang, names, codes)[1], return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "c": c})

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(np.concatenate(list(_places(batch["h"].to_numpy().view(np.uint64), size))))
            first = np.flatnonzero(np.diff(at >> np.uint64(6), prepend=np.uint64(2**63)))
            word = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pd.DataFrame({"at": (at[first] >> np.uint64(6)).astype(np.int64), "word": word.view(np.int64)})

    pairs = docs.mapInPandas(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    marked = pairs.select("h").mapInPandas(mark, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    out = np.zeros(size // 64, np.int64)
    found = written(marked, "sieve")                   # `size` bits at most
    part = found.toPandas()
    out[part["at"].to_numpy()] = part["word"].to_numpy()
    remove(found)
    return out.view(np.uint64)


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for at in _places(h, 64 * len(bits)):
        out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return out


# ---- counts ---------------------------------------------------------------------------------------

def _phrases(names: list[bytes], codes: np.ndarray, goes_on: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
    """The phrases of a run by number of words, none and one included, with their counts; `goes_on` tells
    at which words a pair starts that may count."""
    at = np.flatnonzero(codes)
    yield [""], np.array([len(at)])
    used, owner, count = np.unique(codes[at], return_inverse=True, return_counts=True)
    text = np.array(names, object)[used]
    yield [t.decode() for t in text], count
    for k in range(1, MOST):
        on = goes_on[at + k - 1]
        at, owner = at[on], owner[on]
        if not len(at):
            return
        key, owner, count = np.unique(owner * len(names) + codes[at + k], return_inverse=True, return_counts=True)
        text = text[key // len(names)] + np.array([b" " + w for w in names], object)[key % len(names)]
        yield [t.decode() for t in text], count


def counts(docs: DataFrame, bits: np.ndarray, least: int, run: int) -> DataFrame:
    """(lang, phrase, f) for phrases of up to MOST words that occur `least` times or more, and the number of
    all words as the count of the empty phrase."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)       # its size is fixed

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, names, codes in word_runs(batches, run):
            at, h = pair_hashes(lang, names, codes)
            goes_on = np.zeros(len(codes) + MOST, bool)
            goes_on[at] = passes(shared.value, h)
            for text, f in _phrases(names, codes, goes_on):
                yield pd.DataFrame({"lang": pd.Series([lang] * len(f), dtype=object), "phrase": pd.Series(text, dtype=object), "f": f})

    found = docs.mapInPandas(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return found.where((F.col("f") >= least) | (F.col("phrase") == ""))


# ---- streams and merges ---------------------------------------------------------------------------

def backwards(phrase):
    """The words from the last to the first."""
    return F.array_join(F.reverse(F.split(phrase, " ")), " ")


def _first(count):
    """The first `count` words of `phrase`; if negative, the last ones."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), count.cast("int"))


def in_order(found: DataFrame, key, name: str) -> DataFrame:
    """The count stream sorted by `key`, written."""
    rows = found.select("lang", key.alias("key"), F.col("f"))
    return written(rows.repartitionByRange("lang", "key").sortWithinPartitions("lang", "key"), name)


def lockstep(asks: DataFrame, stream: DataFrame, answer: str) -> DataFrame:
    """`asks` (lang, key, row and more) with the count of their key in `stream` as `answer`."""
    own = asks.columns
    askers = asks.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)).cast("int"))
    given = stream.select("lang", "key", "f", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
    both = given.unionByName(askers, allowMissingColumns=True).repartitionByRange("lang", "key", "share")
    # dealt by range and sorted: Spark needs no further exchange for this window, and keeps one count at a time
    so_far = Window.partitionBy("lang", "key", "share").orderBy(F.col("f").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(answer, F.first("f").over(so_far)).where("f is null").select(*own, answer)


def collocations(docs: DataFrame, least: int = LEAST, sieve_size: int = 2**SIEVE_BITS, run: int = RUN) -> DataFrame:
    """lang, phrase, k, a, l, r, n and score of all candidates that aren't dropped; a row each."""
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    found = written(counts(docs, sieve(docs, least, sieve_size, run), least, run), "counts")
    several = found.where("phrase <> ''")
    prefix = in_order(several, F.col("phrase"), "prefix-order")
    suffix = in_order(several, backwards(F.col("phrase")), "suffix-order")

    size = F.size(F.split("phrase", " "))
    cuts = found.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), size.alias("size")).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = lockstep(cuts.withColumn("key", _first(F.col("k"))), prefix, "l")
    right = left.withColumn("key", backwards(_first(F.col("k") - F.col("size"))))
    told = written(lockstep(right, suffix, "r"), "cuts")

    total = found.where("phrase = ''").select("lang", F.col("f").alias("n"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    scored = told.join(total, "lang").withColumn("up", wide("a") * wide("n")).withColumn("down", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("up * 1000 div down")).select(
        "lang", "phrase", F.struct("score", "k", "a", "l", "r", "n").alias("cut"), F.lit(False).alias("held"))
    # a phrase without its last or first word is held by it if both have the same count
    inside = told.where("size > 2 and k = size - 1 and a >= l").select("lang", _first(F.col("k")).alias("phrase")).unionAll(
        told.where("size > 2 and k = 1 and a >= r").select("lang", _first(1 - F.col("size")).alias("phrase")))
    rows = scored.unionByName(inside.withColumn("held", F.lit(True)), allowMissingColumns=True)
    best = rows.groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.max("held").alias("held"))
    return best.where("not held").select("lang", "phrase", "cut.*")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` rows of each language, with `rank` from 1; chosen in shares first, since one language
    may hold most."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shares = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    first = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).drop("share")
