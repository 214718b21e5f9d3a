"""Fill-in-middle transformation, its cuts found by a piecewise-linear learned rank index.

A document of n code points is cut in three at two places drawn from its doc_id, and its parts are
put in another order behind the marks `<P>`, `<S>` and `<M>` (prefix, suffix, middle):
  psm    <P>prefix<S>suffix<M>middle
  spm    <S>suffix<P>prefix<M>middle
  plain  the text as it is: an empty one, one that holds a mark, and PLAIN_FROM to 99 of a hundred
What is drawn depends on the doc_id alone: h1 to h4 are the first four 8-digit groups of the hex
sha256 of `<seed>:<doc_id>`.  Prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) code
points, middle after the larger; h3 tells plain ones, h4 tells spm from psm.

Texts are cut as UTF-8 bytes, so a cut after k code points needs the byte offset of boundary k.  All
boundaries of an Arrow batch are one rising sequence.  `fit` covers it with line segments (greedy,
each as long as a line stays within ERROR of all its boundaries) and stores what each boundary is off
its line in one byte; `RankIndex.offsets` predicts a cut from its segment's line and corrects it by the
stored residual, which is exact.

Defined results: a null text counts as empty and gives an empty plain output; a null doc_id draws from
`<seed>:`; rows that repeat a doc_id are cut alike if their lengths are alike; texts of any length are
cut whole; an empty table gives an empty result; `transform` keeps other columns and replaces those
named n, form, output, prefix_chars and middle_chars.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.llm.storage import schema_with, without

SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ERROR = 63                   # of a predicted offset; with rounding, a residual still fits a byte
FIRST_LOOK = 1 << 12         # boundaries that a new segment looks at first; each further look is twice as wide
MADE = "n long, form string, output string, prefix_chars long, middle_chars long"


# ---- the learned index ----------------------------------------------------------------------------

class RankIndex(NamedTuple):
    """Byte offsets of code point boundaries by rank."""
    first: np.ndarray        # of each segment, the first rank
    base: np.ndarray         # and the offset there
    slope: np.ndarray
    residual: np.ndarray     # of each rank: its offset less the predicted one

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks]


def boundaries(data: np.ndarray) -> np.ndarray:
    """The offsets at which code points start, and the end."""
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def _segment(y: np.ndarray, s: int) -> tuple[int, float]:
    """The end (exclusive) and the slope of the longest segment that starts at rank s: as long as some
    slope passes within ERROR of each boundary."""
    low, high, at, look = -np.inf, np.inf, s + 1, FIRST_LOOK
    while at < len(y):
        stop = min(at + look, len(y))
        run, rise = np.arange(at - s, stop - s), y[at:stop] - y[s]
        lows = np.maximum(np.maximum.accumulate((rise - ERROR) / run), low)
        highs = np.minimum(np.minimum.accumulate((rise + ERROR) / run), high)
        bad = np.flatnonzero(lows > highs)
        if len(bad):
            k = bad[0]
            if k:
                low, high = lows[k - 1], highs[k - 1]
            return at + int(k), (low + high) / 2
        low, high, at, look = lows[-1], highs[-1], stop, 2 * look
    return len(y), (low + high) / 2 if at > s + 1 else 0.0


def fit(y: np.ndarray) -> RankIndex:
    first, slopes, s = [], [], 0
    while s < len(y):
        end, slope = _segment(y, s)
        first.append(s)
        slopes.append(slope)
        s = end
    at = np.array(first, np.int64)
    bare = RankIndex(at, y[at], np.array(slopes), np.zeros(len(y), np.int8))
    return bare._replace(residual=(y - bare.predicted(np.arange(len(y)))).astype(np.int8))


# ---- the transformation ---------------------------------------------------------------------------

def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """h1 to h4."""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(d[k:k + 8], 16) for k in (0, 8, 16, 24))


def arranged(text: bytes, form: str, lo: int, hi: int) -> bytes:
    """The output for cuts at the bytes lo and hi."""
    head, mid, tail = text[:lo], text[lo:hi], text[hi:]
    if form == "psm":
        return b"".join((PREFIX, head, SUFFIX, tail, MIDDLE, mid))
    return b"".join((SUFFIX, tail, PREFIX, head, MIDDLE, mid)) if form == "spm" else text


def restored(output: str, form: str) -> str:
    """The text from its output and form alone."""
    if form == "plain":
        return output
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    rest, _, mid = output.partition(m)
    if form == "psm":
        head, _, tail = rest[len(p):].partition(s)
    else:
        tail, _, head = rest[len(s):].partition(p)
    return head + mid + tail


def _cut(ids: list, texts: list[bytes], seed: int) -> Iterator[tuple]:
    """(n, form, output, prefix_chars, middle_chars) of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    y = boundaries(data)
    start = np.cumsum([0, *map(len, texts)])                 # of each text, in bytes
    rank = np.searchsorted(y, start)                         # and in code points
    n = np.diff(rank)
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    index = fit(y)
    cut_lo, cut_hi = index.offsets(rank[:-1] + lo) - start[:-1], index.offsets(rank[:-1] + hi) - start[:-1]
    for k, text in enumerate(texts):
        if not text or h[k, 2] % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            yield int(n[k]), "plain", text, None, None
        else:
            form = "spm" if h[k, 3] % 100 < SPM_BELOW else "psm"
            yield int(n[k]), form, arranged(text, form, cut_lo[k], cut_hi[k]), int(lo[k]), int(hi[k] - lo[k])


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """`docs` with n, form, output, prefix_chars and middle_chars (null where plain)."""
    own = without(docs, "n", "form", "output", "prefix_chars", "middle_chars")
    whole = schema_with(docs.select(*own), MADE)
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = whole.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names) - 4).cast(pa.binary()).to_pylist()
            made = zip(*_cut(batch.column(len(names) - 5).to_pylist(), [t or b"" for t in texts], seed))
            columns = [pa.array(c, pa.binary()).cast(t) if pa.types.is_string(t) and k == 2 else pa.array(c, t)
                       for k, (c, t) in enumerate(zip(made, types, strict=True))]
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(batch.columns[:len(names) - 5] + columns, names=names)

    return docs.select(*own, F.col("doc_id").alias("fim_id"), F.col("text").alias("fim_text")).mapInArrow(run, whole)


def restore(output: Column, form: Column) -> Column:
    """The text rebuilt from `output` and `form`."""
    @F.pandas_udf("string")
    def rebuilt(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restored(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return rebuilt(output, form)
