"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

`pieces` tokenizes and cuts documents; `pack` places pieces in sequences of CAPACITY tokens.  Pieces
that fill a sequence have one to themselves.  The others are dealt by hash into shards of about
SHARD pieces, and each shard is solved by ISLANDS islands, each a row and so a task's work of its own.
An island keeps a population of whole packings.  Crossover injects well-filled sequences of one parent
whole into another, removes the sequences there that hold the same pieces, and places the displaced
pieces by best fit, the longest first.  After each epoch the best packings of an island migrate to
the next island of its shard; at the end the fittest packing of the shard wins.  Then the pieces of
sequences with much room left are dealt anew, into other shards, and packed once more, so that the
remainders of the shards meet.  A sequence is named by the least number of its pieces and the round,
so no two share a name, however many a shard has.

Defined results: a null text is empty; an empty document is one piece of the closing id alone;
repeated rows are packed each; ties are broken by the pieces' numbers; any text length is cut, never
dropped; an empty table gives an empty result; other columns of `docs` are ignored.
"""
from __future__ import annotations

import os
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxodds.llm.storage import remove, written

CAPACITY = 2048
CLOSING = b"\0\0\0\0"             # id 0 ends each document
SHARD, ISLANDS, EPOCHS, POPULATION, CROSSOVERS, ELITE = 4096, 2, 2, 5, 8, 2
ROOMY = 0.98                      # sequences filled less than this are packed once more
CACHE_CHUNKS, CACHE_WORDS, CACHED_LENGTH = 200_000, 600_000, 48
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]{0,40})([.,;:!?#$%&*]{0,8})")
_BEYOND_ASCII = [chr(k) for k in range(0xDF, 0x100) if k != 0xF7]       # lower-case letters of _WORD
AT_ONCE = 1 << 14                 # characters of texts whose chunks are looked up together (few, for the processor's cache)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Tokens:
    """Ids of texts, as little-endian 32-bit bytes.

    The tokenizer never joins what stands on two sides of a blank, tab or line break, so a text's ids
    are those of its chunks between them, which repeat; their ids are kept: CACHE_CHUNKS, and as many of
    the time before, from which those met again return.  Most
    new chunks are a Latin word and marks, which it tokenizes apart and in lower case, so their ids are
    put together from those of the word and the marks.  Words (CACHE_WORDS are kept) go straight to the
    tokenizer's model, letters beyond ASCII spelt as its pre-tokenizer spells them.  Texts come some at a time,
    so that a chunk which several of them share is looked up once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.words = Tokenizer.from_file(path), {}, {"": b""}
        self.before: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.spelt = {ord(x): "".join(y for y, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(x)) for x in _BEYOND_ASCII}

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words of lower-case letters alone."""
        ids, ends = [], [0]
        for word in words:
            ids += [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.spelt))]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        for word, a, b in zip(words, ends, ends[1:], strict=False):
            self.words[word] = data[a:b]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        plain = {c: (m[1].lower(), m[2]) for c in chunks if (m := _WORD.fullmatch(c))}
        new = {w for w, _ in plain.values()}.difference(self.words)
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
            new = {w for w, _ in plain.values() if w}
        self._learn_words(list(new))
        marks = list({m for _, m in plain.values()}.difference(self.words))
        others = [c for c in chunks if c not in plain]
        encoded = self._encode(marks + others) if marks or others else []
        self.words.update(zip(marks, encoded, strict=False))
        found = {c: self.words[w] + self.words[m] for c, (w, m) in plain.items()}
        return found | dict(zip(others, encoded[len(marks):], strict=True))

    def many(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for text in texts]
        met = set().union(*split)
        ids = dict(zip(met, map(self.known.get, met), strict=True))
        new = [c for c, b in ids.items() if b is None]
        if new:
            found = {c: self.before[c] for c in new if c in self.before}
            found |= self._learn([c for c in new if c not in found])
            if len(self.known) > CACHE_CHUNKS:
                self.known, self.before = {}, self.known
            self.known.update((c, b) for c, b in found.items() if len(c) <= CACHED_LENGTH)
            ids |= found
        return [b"".join(map(ids.__getitem__, chunks)) for chunks in split]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@cache
def tokens(path: str) -> Tokens:
    """One for a worker, so that what it knows serves all its tasks."""
    return Tokens(path)


def cut(ids: bytes) -> Iterator[tuple[int, bytes]]:
    """(start, ids) of each piece."""
    for at in range(0, len(ids), 4 * CAPACITY):
        yield at // 4, ids[at:at + 4 * CAPACITY]


def _some(docs: Iterable[tuple[int, str | None]]) -> Iterator[list[tuple[int, str | None]]]:
    """The documents in lists of AT_ONCE characters; a longer one is alone."""
    some, size = [], 0
    for row in docs:
        if some and size + len(row[1] or "") > AT_ONCE:
            yield some
            some, size = [], 0
        some.append(row)
        size += len(row[1] or "")
    if some:
        yield some


def pieces(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of each document; `ids` is null unless asked for."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = tokens(path).many
        for batch in batches:
            rows = [(doc_id, k, start, len(ids) // 4, zlib.crc32(ids), ids if with_ids else None)
                    for some in _some(zip(batch["doc_id"], batch["text"], strict=True))
                    for (doc_id, _), whole in zip(some, ids_of([text or "" for _, text in some]), strict=True)
                    for k, (start, ids) in enumerate(cut(whole + CLOSING))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, PIECES)


# ---- one island ------------------------------------------------------------------------------------

def best_fit(lengths: list[int], order: Iterable[int], bins: list[list[int]], room: list[int]) -> None:
    """Place the pieces of `order` into the bin with the least room that suffices, or a new one."""
    holes: dict[int, list[int]] = {}
    mask = 0                       # bit r: some bin has room r
    for b, r in enumerate(room):
        if bins[b]:
            holes.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in order:
        fits = mask >> lengths[i]
        if fits:
            r = lengths[i] + (fits & -fits).bit_length() - 1
            b = holes[r].pop()
            if not holes[r]:
                mask ^= 1 << r
        else:
            b, r = len(bins), CAPACITY
            bins.append([])
            room.append(r)
        bins[b].append(i)
        r -= lengths[i]
        room[b] = r
        holes.setdefault(r, []).append(b)
        mask |= 1 << r


def _packing(lengths: list[int], order: Iterable[int]) -> np.ndarray:
    bins: list[list[int]] = []
    best_fit(lengths, order, bins, [])
    return _numbered(bins, len(lengths))


def _numbered(bins: list[list[int]], n: int) -> np.ndarray:
    """The bin of each piece, bins numbered without gaps."""
    out = np.zeros(n, np.int32)
    for k, b in enumerate(x for x in bins if x):
        out[b] = k
    return out


def fitness(lengths: np.ndarray, packing: np.ndarray) -> float:
    """Mean squared fill: few sequences, and full rather than even ones."""
    fill = np.bincount(packing, lengths)
    return float(np.mean((fill / CAPACITY) ** 2))


def crossover(lengths: np.ndarray, sizes: list[int], giver: np.ndarray, taker: np.ndarray, rng: random.Random) -> np.ndarray:
    """`taker` with a choice of the well-filled sequences of `giver`."""
    fill = np.bincount(giver, lengths)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    taken = np.zeros(len(fill), bool)
    taken[rng.sample(good.tolist(), max(1, len(good) // 2))] = True
    injected = taken[giver]
    broken = np.zeros(taker.max() + 1, bool)
    broken[taker[injected]] = True
    stays = ~broken[taker]
    displaced = np.flatnonzero(~stays & ~injected)
    group = np.where(injected, giver, taker + len(fill))
    at = np.flatnonzero(injected | stays)
    at = at[np.argsort(group[at], kind="stable")]
    edges = np.flatnonzero(np.diff(group[at])) + 1
    bins = [b.tolist() for b in np.split(at, edges)]
    room = [CAPACITY - sum(sizes[i] for i in b) for b in bins]
    best_fit(sizes, sorted(displaced.tolist(), key=lambda i: (-sizes[i], i)), bins, room)
    return _numbered(bins, len(sizes))


def evolve(lengths: np.ndarray, migrants: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """One epoch of an island: its ELITE fittest packings, the best first."""
    rng, sizes = random.Random(seed), lengths.tolist()
    people = [*migrants]
    falling = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    if not people:
        people.append(_packing(sizes, falling))
    while len(people) < POPULATION:                       # the longest first, with some disorder
        noise = [rng.uniform(0.6, 1.0) for _ in sizes]
        people.append(_packing(sizes, sorted(falling, key=lambda i: -sizes[i] * noise[i])))
    ranked = sorted(((fitness(lengths, p), k, p) for k, p in enumerate(people)), reverse=True)
    least = -(-int(lengths.sum()) // CAPACITY)
    for step in range(CROSSOVERS):
        if ranked[0][2].max() + 1 <= least:
            break
        (_, _, giver), (_, _, taker) = rng.sample(ranked[:POPULATION], 2)
        child = crossover(lengths, sizes, giver, taker, rng)
        ranked = sorted([*ranked, (fitness(lengths, child), len(people) + step, child)], reverse=True)[:POPULATION]
    return [p for _, _, p in ranked[:ELITE]]


STATE = "shard long, island int, numbers array<long>, lengths array<int>, elite array<binary>, fitness double"


def _epoch(state: DataFrame, epoch: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = np.asarray(row.lengths, np.int64)
                before = [np.frombuffer(x, np.int32) for x in row.elite]
                best = evolve(lengths, before, seed=hash((int(row.shard), int(row.island), epoch)))
                yield pd.DataFrame([(row.shard, row.island, row.numbers, row.lengths, [p.tobytes() for p in best],
                                     fitness(lengths, best[0]))],
                                   columns=["shard", "island", "numbers", "lengths", "elite", "fitness"])

    return state.mapInPandas(run, STATE)


def _solve(items: DataFrame, n_items: int, salt: int) -> DataFrame:
    """number, offset and fill of each of `items` (number, length), and its sequence, which is named by
    the least number in it."""
    spark = items.sparkSession
    n = max(1, -(-n_items // SHARD))
    tasks = min(n * ISLANDS, max(8, 4 * spark.sparkContext.defaultParallelism))
    shards = (items.groupBy(F.pmod(F.xxhash64("number", F.lit(salt)), F.lit(n)).alias("shard"))
              .agg(F.sort_array(F.collect_list(F.struct("length", "number")), asc=False).alias("p"))
              .select("shard", F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])).alias("island"),
                      F.col("p.number").alias("numbers"), F.col("p.length").alias("lengths"),
                      F.array().cast("array<binary>").alias("elite"), F.lit(0.0).alias("fitness")))
    state = shards
    for epoch in range(EPOCHS):
        done = written(_epoch(state.repartition(tasks, "shard", "island"), epoch), "islands")
        came = done.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("came"))
        state = done.join(came, ["shard", "island"]).withColumn("elite", F.concat("elite", "came")).drop("came")
    best = done.groupBy("shard").agg(F.max_by(F.struct("numbers", "lengths", F.col("elite")[0].alias("packing")),
                                              F.struct("fitness", -F.col("island"))).alias("b"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for numbers, lengths, packing in batch.itertuples(index=False):
                bins, lengths = np.frombuffer(packing, np.int32), np.asarray(lengths, np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[order])
                first = np.searchsorted(bins[order], bins[order])          # where each one's bin begins
                begin = ends - lengths[order]
                fill = np.bincount(bins, lengths).astype(np.int64)
                numbers = np.asarray(numbers, np.int64)[order]
                least = np.minimum.reduceat(numbers, np.unique(first))     # by bin; bins are numbered without gaps
                yield pd.DataFrame({"number": numbers, "sequence": least[bins[order]], "offset": begin - begin[first],
                                    "fill": fill[bins[order]]})

    return best.select("b.*").mapInPandas(place, "number long, sequence long, offset long, fill long")


def pack(cut_pieces: DataFrame) -> DataFrame:
    """`cut_pieces` (any columns, `length` among them) with sequence_id and offset (which replace
    columns so named)."""
    numbered = written(cut_pieces.select(F.struct("*").alias("row"), F.col("length").cast("int").alias("length"),
                                         F.monotonically_increasing_id().alias("number")), "pieces")
    open_ = numbered.where(F.col("length") < CAPACITY).select("number", "length")
    first = written(_solve(open_, open_.count(), 0), "first")
    roomy = F.col("fill") < ROOMY * CAPACITY
    again = written(first.where(roomy).select("number").join(open_, "number"), "again")
    second = written(_solve(again, again.count(), 1), "second")
    # a second round that needs more sequences than it replaces is left out
    bins = lambda df: df.select("sequence").distinct().count()
    placed = [(first, 0)] if bins(second) >= bins(first.where(roomy)) else [(first.where(~roomy), 0), (second, 1)]
    where = None
    for df, level in placed:
        part = df.select("number", (F.col("sequence") * 4 + level).alias("sequence_id"), "offset")
        where = part if where is None else where.unionAll(part)
    full = (numbered.where(F.col("length") >= CAPACITY)
            .withColumns({"sequence_id": F.col("number") * 4 + 2, "offset": F.lit(0).cast("long")}))
    own = [F.col("row")[c].alias(c) for c in cut_pieces.columns if c not in ("sequence_id", "offset")]
    return numbered.join(where, "number").unionByName(full).select(*own, "sequence_id", "offset")


def sequences(packed_with_ids: DataFrame) -> DataFrame:
    """sequence_id and its ids (little-endian 32-bit), from packed pieces that carry theirs."""
    g = packed_with_ids.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return g.select("sequence_id", F.aggregate(F.col("p.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
