"""Exact substring dedup: remove every byte covered by a string of LENGTH bytes that also starts
anywhere else, in the same document or another.

Equal strings must meet in one task.  So each start of such a string is assigned the least hash of
any GRAM-byte gram in it (the leftmost, if it repeats): equal strings have equal grams at the same
place.  The starts that share a gram's place form a fragment: a few hundred starts and the bytes of
their strings.  Fragments are grouped by the gram's hash:
  - fragments of equal bytes are counted before any shuffle; counted twice, all their starts repeat;
  - of the other fragments whose gram also stands elsewhere, one copy each goes to the task that
    holds their grams, and the starts there are put in suffix order by two-stage sorting: only
    suffixes smaller than their successors are sorted directly, the others are induced by scanning
    the buckets; strings that repeat are then found by the common prefixes of neighbours;
  - a gram with more than HOT fragments of different bytes isn't gathered: the starts of all its
    fragments are grouped by a 128-bit hash of their strings.
The verdicts return to all fragments by a join on (gram, bytes).

Fragments of equal bytes, and strings of hot grams, are told by 128-bit hashes.
Defined results: a null text is empty; a text under LENGTH bytes loses nothing; rows are told apart by
doc_id and text together, and rows that repeat both remove each other's text as any copy does; a null
doc_id is a value; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxodds.llm.storage import written

LENGTH, GRAM = 400, 32
HOT = 5_000                  # different fragments of one gram
SEGMENT = 1 << 22            # starts handled at once in a long document
BATCH = 200_000              # starts sorted at once, or one gram's
HANDED = 8 << 20             # bytes of fragments that are handed back to Spark at once
KEY = ("doc_id", "text_key")
FRAGMENT = ("gram", "bytes_a", "bytes_b")


# ---- fragments ------------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes from each place."""
    h, width, factor = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % 2**64
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def fragments(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(gram hash, first start, number of starts) of each fragment."""
    for base in range(0, len(data) - LENGTH + 1, SEGMENT):
        part = np.frombuffer(data[base:base + SEGMENT + LENGTH - 1], np.uint8)
        hashes = gram_hashes(part)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64(0xFFFFFF)
        least = _sliding_min((hashes & ~low) | place, LENGTH - GRAM + 1) & low
        first = np.flatnonzero(np.diff(least, prepend=np.uint64(0xFFFFFF)))
        count = np.diff(first, append=len(least))
        for h, a, n in zip(hashes[least[first]].astype(np.int64).tolist(), first.tolist(), count.tolist(), strict=True):
            yield h, base + a, n


_ROWS = "doc_id long, text_key long, gram long, bytes_a long, bytes_b long, n_starts int, at array<int>"


def fragment_rows(docs: DataFrame) -> DataFrame:
    """One row for each document and different fragment in it; `at` has its places."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, key, text in batch.itertuples(index=False):
                data, own = (text or "").encode(), {}
                for gram, a, n in fragments(data):
                    own.setdefault((gram, xxhash.xxh3_128_intdigest(data[a:a + n + LENGTH - 1]), n), []).append(a)
                rows += [(doc_id, key, gram, (digest >> 64) - 2**63, (digest & 2**64 - 1) - 2**63, n, at)
                         for (gram, digest, n), at in own.items()]
                if len(rows) > 50_000:
                    yield _frame(rows, _ROWS)
                    rows = []
            yield _frame(rows, _ROWS)

    return docs.select("doc_id", "text_key", "text").mapInPandas(run, _ROWS)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    return out.astype({"doc_id": "Int64"}) if "doc_id" in out.columns else out


# ---- suffix order ---------------------------------------------------------------------------------

def two_stage_order(text: bytes, wanted: np.ndarray) -> np.ndarray:
    """The wanted places of `text` in the order of their suffixes, as far as LENGTH bytes tell.

    `wanted` is a mask; a place that is larger than its successor needs the latter, so wanted runs
    are continued to the next place that is smaller than its successor."""
    t = np.frombuffer(text + b"\x00\xff", np.uint8)
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])                    # the last place of each run of one byte
    up = np.repeat(t[change + 1] > t[change], np.diff(change, prepend=-1))
    smaller = np.zeros(n, bool)                                 # than the successor
    smaller[:len(up)] = up
    active = np.zeros(n, bool)
    active[:len(wanted)] = wanted
    ups = np.flatnonzero(smaller)
    ends = np.flatnonzero(active[:-1] & ~active[1:])
    for a, b in zip(ends.tolist(), ups[np.searchsorted(ups, ends)].tolist(), strict=True):
        active[a:b + 1] = True
    direct = sorted(np.flatnonzero(active & smaller).tolist(), key=lambda p: text[p:p + LENGTH])
    direct = np.array(direct, np.int64)
    first = t[direct] if len(direct) else np.zeros(0, np.uint8)
    bounds = np.searchsorted(first, np.arange(257))             # direct suffixes come in order of their first byte
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        batch = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        bucket = []
        while len(batch):                                       # runs of the byte itself
            bucket.append(batch)
            before = batch[batch > 0] - 1
            batch = before[active[before] & (t[before] == c)]
        bucket.append(direct[bounds[c]:bounds[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[active[before] & (t[before] > c)]
        if len(before):
            byte = t[before]
            order = np.argsort(byte, kind="stable")
            cuts = np.flatnonzero(np.diff(byte[order])) + 1
            for part in np.split(before[order], cuts):
                pending[t[part[0]]].append(part)
        pending[c] = []
    order = np.concatenate(out)
    return order[order < len(wanted)]


def common_prefixes(text: bytes, order: np.ndarray) -> np.ndarray:
    """Of each two neighbours, the common prefix in bytes, in steps of eight up to LENGTH."""
    t = np.frombuffer(text + bytes(LENGTH + 8), np.uint8)
    eight = np.zeros(len(t) - 7, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | t[k:len(t) - 7 + k]
    a, b = order[:-1], order[1:]
    prefix = np.zeros(len(a), np.int32)
    left = np.arange(len(a))
    for k in range(0, LENGTH, 8):
        left = left[eight[a[left] + k] == eight[b[left] + k]]
        if not len(left):
            break
        prefix[left] += 8
    return prefix


def repeated_starts(pieces: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """For fragments (number of starts, bytes), the mask of starts whose strings repeat among them."""
    text = b"".join(p for _, p in pieces)
    wanted = np.zeros(len(text), bool)
    base = np.cumsum([0, *(len(p) for _, p in pieces)])
    for (n, _), a in zip(pieces, base, strict=False):
        wanted[a:a + n] = True
    order = two_stage_order(text, wanted)
    order = order[wanted[order]]
    same = common_prefixes(text, order) >= LENGTH
    found = np.zeros(len(text), bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return [found[a:a + n] for (n, _), a in zip(pieces, base, strict=False)]


def _runs(mask: np.ndarray) -> list[dict[str, int]]:
    """[start, end) of the runs of a mask."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_RUNS = "array<struct<a:int,b:int>>"
_VERDICT = f"gram long, bytes_a long, bytes_b long, runs {_RUNS}"


def _sorted_verdicts(rows: DataFrame) -> DataFrame:
    """Verdicts of the fragments (with `bytes`) of grams that aren't hot; one gram is in one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, starts, last = [], 0, None

        def judged() -> pd.DataFrame:
            masks = repeated_starts([(r.n_starts, r.bytes) for r in held])
            return _frame([(r.gram, r.bytes_a, r.bytes_b, _runs(m)) for r, m in zip(held, masks, strict=True) if m.any()],
                          "gram long, bytes_a long, bytes_b long, runs x")

        for batch in batches:
            for row in batch.itertuples(index=False):
                if held and held[-1][:3] == row[:3]:
                    continue
                if starts > BATCH and row.gram != last:
                    yield judged()
                    held, starts = [], 0
                held.append(row)
                starts, last = starts + row.n_starts, row.gram
        if held:
            yield judged()

    dealt = rows.repartition("gram").sortWithinPartitions(*FRAGMENT)
    return dealt.select(*FRAGMENT, "n_starts", "bytes").mapInPandas(run, _VERDICT)


def hashed_strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each string of fragments (with `bytes`), those of many fragments in one frame."""
    made, size = [], 0
    for batch in batches:
        for r in batch.itertuples(index=False):
            digests = [xxhash.xxh3_128_digest(r.bytes[k:k + LENGTH]) for k in range(r.n_starts)]
            made.append((r, digests))
            size += 64 * len(digests)              # bytes of an object of 16 bytes, some more
            if size > HANDED:
                yield _string_frame(made)
                made, size = [], 0
    if made:
        yield _string_frame(made)


def _string_frame(made: list[tuple]) -> pd.DataFrame:
    counts = [len(digests) for _, digests in made]
    out = {c: np.repeat(np.array([getattr(r, c) for r, _ in made], np.int64), counts) for c in FRAGMENT}
    return pd.DataFrame(out | {"k": np.concatenate([np.arange(n, dtype=np.int32) for n in counts]),
                               "string": [d for _, digests in made for d in digests]})


def _hot_verdicts(rows: DataFrame) -> DataFrame:
    """Verdicts of the fragments of hot grams, by the hashes of their strings."""
    starts = rows.dropDuplicates([*FRAGMENT]).select(*FRAGMENT, "n_starts", "bytes").mapInPandas(
        hashed_strings, "gram long, bytes_a long, bytes_b long, k int, string binary")
    twice = starts.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    one = F.struct(F.col("k").alias("a"), (F.col("k") + 1).alias("b"))
    return starts.join(twice, "string").groupBy(*FRAGMENT).agg(F.sort_array(F.collect_list(one)).alias("runs"))


# ---- the operator ---------------------------------------------------------------------------------

def _same(prefix: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id")) & (F.col("text_key") == F.col(f"{prefix}text_key"))


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (one fragment of a document each) with its `bytes`; more than once for repeated rows."""
    own = wanted.groupBy(F.col("doc_id").alias("w_doc_id"), F.col("text_key").alias("w_text_key")).agg(
        F.collect_list(F.struct(*FRAGMENT, "n_starts", "start", "hot")).alias("wanted"))
    return docs.join(own, _same("w_")).select("text", "wanted").mapInPandas(cut_out, _CUT)


_CUT = "gram long, bytes_a long, bytes_b long, n_starts int, hot boolean, bytes binary"


def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The wanted fragments of texts with their `bytes`, those of many texts in one frame."""
    rows, size = [], 0
    for batch in batches:
        for text, wanted in batch.itertuples(index=False):
            data = text.encode()
            for w in wanted:
                part = data[w["start"]:w["start"] + w["n_starts"] + LENGTH - 1]
                rows.append((w["gram"], w["bytes_a"], w["bytes_b"], w["n_starts"], w["hot"], part))
                size += len(part)
                if size > HANDED:
                    yield _frame(rows, _CUT)
                    rows, size = [], 0
    if rows:
        yield _frame(rows, _CUT)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the runs of starts whose strings repeat, for documents that have any."""
    rows = written(fragment_rows(docs), "fragments")
    counted = rows.groupBy(*FRAGMENT).agg(
        F.sum(F.size("at")).alias("n"), F.first("n_starts").alias("n_starts"),
        F.min(F.struct("doc_id", "text_key", F.col("at")[0].alias("start"))).alias("one"))
    kinds = counted.withColumn("kinds", F.count(F.lit(1)).over(Window.partitionBy("gram")))
    kinds = written(kinds.where((F.col("n") > 1) | (F.col("kinds") > 1)), "kinds")
    mixed = kinds.where("kinds > 1").select(*FRAGMENT, "n_starts", "one.*", (F.col("kinds") > HOT).alias("hot"))
    fetched = written(_fetched(docs, mixed), "mixed")
    verdicts = _sorted_verdicts(fetched.where("not hot")).unionAll(_hot_verdicts(fetched.where("hot")))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n_starts").alias("b"))).cast(_RUNS)
    twice = kinds.where("n > 1").select(*FRAGMENT, whole.alias("runs"))
    once = kinds.where("n = 1 and kinds > 1").select(*FRAGMENT).join(verdicts, [*FRAGMENT])
    found = written(twice.unionByName(once), "verdicts")
    return (rows.join(found, [*FRAGMENT])
            .groupBy(*KEY).agg(F.collect_list(F.struct("at", "runs")).alias("found")))


def removed_spans(found: list[dict], size: int) -> np.ndarray:
    """[start, end) of the maximal removed runs of bytes."""
    edges = np.zeros(size + 1, np.int32)
    for f in found:
        runs = [(r["a"], r["b"]) for r in f["runs"]]
        for at in f["at"]:
            for a, b in runs:
                edges[at + a] += 1
                edges[at + b + LENGTH - 1] -= 1
    return np.array([(r["a"], r["b"]) for r in _runs(np.cumsum(edges[:-1]) > 0)], np.int64).reshape(-1, 2)


def dedup(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, `data` (the remaining bytes; they needn't be valid UTF-8),
    n_bytes, n_removed and n_spans."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    found = repeated_runs(keyed).withColumnsRenamed({k: f"f_{k}" for k in KEY})
    joined = keyed.join(found, _same("f_"), "left").select("doc_id", "text", "found")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, own in batch.itertuples(index=False):
                data = text.encode()
                spans = removed_spans(own, len(data)) if own is not None else np.zeros((0, 2), np.int64)
                edges = [0, *spans.ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc_id, kept, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield _frame(rows, "doc_id long, data binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

    return joined.mapInPandas(run, "doc_id long, data binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
