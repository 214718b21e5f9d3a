"""Toxicity: a support vector machine over a gapped string kernel, with Nystroem landmarks.

The kernel of two strings sums, over all subsequences of three letters that span at most SPAN
characters, the products of their weights, DECAY for each character in a gap; it is normalised.  So an
insult with inserted characters ("id-iot", "i.d.i.o.t") or another ending stays close to the plain
one.  A sentence is compared through its units: its words, runs of single letters put together
("i d i o t"), and overlapping windows of very long words; its score is that of its worst unit.

Training (`train`) takes labelled documents.  Sentences aren't labelled singly, so those of toxic
documents are labelled in rounds: at first every unit that clean documents lack is a weak positive,
then only the worst unit of each toxic document, as the machine so far sees it.  Landmarks are units
of both classes; the machine is linear in the Nystroem features of the kernel to them.  Since the
kernel has a finite feature space (three letters), the trained machine is one weight vector over it,
and a unit is scored by a sparse product.  A logistic curve over the document's worst sentence and
its share of bad ones gives the score.

At most SAMPLE_ROWS labelled documents of each class are used, those with the smallest hash of their
doc_id; of these, documents of more than SAMPLE_CHARS code points are left out of the training.
Defined results: a null or empty text has the score of a text without units; texts are scored whole,
whatever their length; scoring is row by row, so repeated rows and ties get equal scores; with no
labelled documents of one class every score is the share of toxic ones (0 without labels).
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS, SAMPLE_CHARS = 2000, 50_000
LANDMARKS = 384
ROUNDS = 5
LENGTH, SPAN, DECAY = 3, 6, 0.6
LONG, WINDOW = 24, 16
SIZE = 32 ** LENGTH
CACHE_UNITS = 250_000
CHUNK = 4_000
THRESHOLD = 0.7

#: Letters 1 to 26, others 27 to 31 by code point; 0 is what can only be a gap.
_CODES = np.zeros(0x110000, np.uint8)
for _c in range(0xAA, 0x30000):
    if chr(_c).isalpha():
        _CODES[_c] = 27 + _c % 5
_CODES[97:123] = np.arange(1, 27)
_CODES[65:91] = np.arange(1, 27)
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_SENTENCE = re.compile(r"[.!?]+\s|\n")


class Model(NamedTuple):
    weights: np.ndarray          # over the kernel's features
    bias: float
    slope: tuple[float, ...]     # of what _bad_sentences returns
    offset: float


def units(text: str) -> list[str]:
    """Words, and what runs of single letters spell."""
    text = text.lower()
    return [*text.split(), *("".join(x.split()) for x in _SPACED.findall(text))]


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s.strip()]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The kernel's features of each word, as (row, feature, value) with unit rows, and the word that
    each row is a part of."""
    parts, owner = [], []
    for k, w in enumerate(words):
        if len(w) <= LONG:
            parts.append(w)
            owner.append(k)
        else:
            cut = [w[i:i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2)]
            parts += cut
            owner += [k] * len(cut)
    width = max(map(len, parts), default=0)
    flat = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _CODES[flat].reshape(len(parts), width).astype(np.int32)
    rows, feats, values = [], [], []
    for second in range(1, SPAN - 1):
        for third in range(second + 1, SPAN):
            if third >= width:
                continue
            a, b, c = codes[:, :width - third], codes[:, second:width - third + second], codes[:, third:]
            row, _ = at = np.nonzero((a > 0) & (b > 0) & (c > 0))
            rows.append(row)
            feats.append((a[at] * 32 + b[at]) * 32 + c[at])
            values.append(np.full(len(row), DECAY ** (third + 1 - LENGTH)))
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0), np.array(owner, np.int64)
    key = np.concatenate(rows).astype(np.int64) * SIZE + np.concatenate(feats)
    key, inverse = np.unique(key, return_inverse=True)
    value = np.bincount(inverse, np.concatenate(values), len(key))
    row, feature = np.divmod(key, SIZE)
    norm = np.sqrt(np.bincount(row, value * value, len(parts)))
    return row, feature, value / norm[row], np.array(owner, np.int64)


def margins(model: Model, words: list[str]) -> np.ndarray:
    """The machine's margin of each word."""
    parts = [_margins(model, words[i:i + CHUNK]) for i in range(0, len(words), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _margins(model: Model, words: list[str]) -> np.ndarray:
    row, feature, value, owner = features(words)
    part = np.bincount(row, value * model.weights[feature], len(owner)) + model.bias
    out = np.full(len(words), -np.inf)
    np.maximum.at(out, owner, part)
    return out


def _dense(words: list[str], used: np.ndarray) -> np.ndarray:
    """Rows of kernel features; words must be at most LONG characters."""
    row, feature, value, _ = features(words)
    at = np.searchsorted(used, feature)
    known = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == feature)
    out = np.zeros((len(words), len(used)), np.float32)
    out[row[known], at[known]] = value[known]
    return out


def _svm(z: np.ndarray, y: np.ndarray, w: np.ndarray, c: float = 20.0) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps; the last column of z is the bias."""
    v = np.zeros(z.shape[1])
    for _ in range(30):
        slack = np.maximum(0.0, 1 - y * (z @ v))
        on = slack > 0
        zw = z[on] * (c * w[on])[:, None].astype(z.dtype)
        step = np.linalg.solve((zw.T @ z[on]).astype(float) + np.eye(len(v)), v - zw.T @ (y[on] * slack[on]))
        v -= step
        if np.abs(step).max() < 1e-5:
            break
    return v


def _bad_sentences(text: str, margin: dict[str, float]) -> tuple[float, float, float]:
    """The worst margin of the text (-1 at least), what it has over a half, and the logarithm of one
    more than its sentences with a margin over zero."""
    worst = max(map(margin.__getitem__, units(text)), default=-1.0)
    bad = sum(any(margin.get(u, -1.0) > 0 for u in units(s)) for s in sentences(text)) if worst > 0 else 0
    return max(-1.0, worst), max(0.0, min(worst, 1.0) - 0.5), float(np.log1p(bad))


def probability(model: Model, text: str, margin: dict[str, float]) -> float:
    return float(1 / (1 + np.exp(-(np.dot(model.slope, _bad_sentences(text, margin)) + model.offset))))


def train(toxic: list[str], clean: list[str], seed: int = 7) -> Model:
    """The machine from the whole texts of labelled documents."""
    if not toxic or not clean:
        share = min(max(len(toxic) / max(1, len(toxic) + len(clean)), 1e-6), 1 - 1e-6)
        return Model(np.zeros(SIZE), 0.0, (0.0, 0.0, 0.0), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    bags = [sorted({u for u in units(t) if len(u) <= LONG}) for t in toxic]
    in_toxic = Counter(u for b in bags for u in b)
    in_clean = Counter(u for t in clean for u in {u for u in units(t) if len(u) <= LONG})
    # documents with the same least unit hash count once, so copies of one document don't add up
    kinds: dict[str, set[int]] = {}
    for b in bags:
        least = min((zlib.crc32(u.encode("utf-8", "replace")) for u in b), default=0)
        for u in b:
            if u not in in_clean:
                kinds.setdefault(u, set()).add(least)
    least = max(3, len(toxic) // 200)
    shared = {u for u, k in kinds.items() if len(k) >= least}
    bags = [c for b in bags if (c := [u for u in b if u not in in_clean])]
    fresh = sorted({u for b in bags for u in b})
    negatives = sorted(in_clean)
    if not fresh or not negatives:
        return Model(np.zeros(SIZE), 0.0, (0.0, 0.0, 0.0), float(np.log(len(toxic) / len(clean))))
    often = sorted(fresh, key=lambda u: (-in_toxic[u], u))[:LANDMARKS // 2]
    common = sorted(negatives, key=lambda u: (-in_clean[u], u))[:2000]
    negatives = common + [negatives[i] for i in sorted(rng.permutation(len(negatives))[:10_000])]
    pick = lambda a, n: [a[i] for i in sorted(rng.permutation(len(a))[:n])]
    chosen: list[str] = pick(fresh, 6000)
    weights = np.array([in_toxic[u] / sum(in_toxic.values()) for u in chosen])
    weights *= len(negatives) / weights.sum() / 4
    model = None
    for k in range(ROUNDS):
        if model:
            margin = dict(zip(fresh, margins(model, fresh), strict=True))
            worst = Counter(max(b, key=lambda u: (margin[u], in_toxic[u], u)) for b in bags)
            worst |= {u: in_toxic[u] for u in shared}
            chosen = sorted(worst)
            weights = np.array([float(worst[u]) for u in chosen])
            weights *= len(negatives) / weights.sum() / 4
            scored = margins(model, sorted(in_clean))
            hard = [u for u, m in sorted(zip(sorted(in_clean), scored, strict=True), key=lambda x: -x[1])[:2000] if m > -1]
            negatives = sorted({*negatives, *hard})
            often = sorted(chosen, key=lambda u: (-worst[u], u))[:LANDMARKS // 2]
        landmarks = [*often, *pick(sorted({*negatives} - {*often}), LANDMARKS - len(often))]
        used = np.unique(features(landmarks)[1])
        base = _dense(landmarks, used)
        value, vector = np.linalg.eigh((base @ base.T).astype(float))
        keep = value > 1e-3
        half = vector[:, keep] / np.sqrt(value[keep])
        project = base.T @ half                                    # Nystroem: features to landmark space
        known = chosen + negatives
        z = np.concatenate([_dense(known[i:i + 1000], used) @ project.astype(np.float32) for i in range(0, len(known), 1000)])
        z = np.hstack([z, np.ones((len(z), 1), np.float32)])
        y = np.repeat([1.0, -1.0], [len(chosen), len(negatives)])
        v = _svm(z, y, np.concatenate([weights, np.ones(len(negatives))]) / len(negatives) * 1000)
        theta = np.zeros(SIZE)
        theta[used] = project @ v[:-1]
        model = Model(theta, float(v[-1]), (1.0, 0.0, 0.0), 0.0)
    # the curve over documents
    seen = sorted({u for t in (*toxic, *clean) for u in units(t)})
    margin = dict(zip(seen, margins(model, seen), strict=True))
    x = np.array([[*_bad_sentences(t, margin), 1.0] for t in (*toxic, *clean)])
    y = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w)), x.T @ (p - y) + 0.01 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return model._replace(slope=tuple(map(float, w[:-1])), offset=float(w[-1]))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """Texts of toxic and of clean documents: the bounded training sample.  A document that is
    labelled more than once is toxic if any label says so; null labels and doc_ids are skipped."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    ids = [known.where(F.col("toxic") == k).orderBy(*order).limit(SAMPLE_ROWS) for k in (1, 0)]
    picked = (docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
              .join(F.broadcast(ids[0].unionAll(ids[1])), "doc_id"))      # 2 * SAMPLE_ROWS rows at most
    rows = sorted({(r["toxic"], r["text"]) for r in picked.select("toxic", "text").toLocalIterator()})
    return [t for k, t in rows if k == 1], [t for k, t in rows if k != 1]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(*sample(docs, labels))


class _Cache:
    """Margins of the units met so far, at most CACHE_UNITS beyond those of the current texts."""

    def __init__(self, model: Model):
        self.model, self.margin = model, {}

    def learn(self, wanted: set[str]) -> dict[str, float]:
        if len(self.margin) > CACHE_UNITS:
            self.margin.clear()
        new = sorted(wanted.difference(self.margin))
        self.margin.update(zip(new, margins(self.model, new).tolist(), strict=True))
        return self.margin


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `toxicity`, 0 to 1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _Cache(model)
        for texts in batches:
            out = []
            for text in texts:
                margin = cache.learn(set(units(text or "")))
                out.append(probability(model, text or "", margin))
            yield pd.Series(out, dtype=float)

    return docs.withColumn("toxicity", score("text"))


def scored_sentences(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, sentence and margin of each sentence; over 0 is toxic."""
    @F.pandas_udf("array<struct<sentence:string,margin:double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _Cache(model)
        for texts in batches:
            out = []
            for text in texts:
                found = [(s, units(s)) for s in sentences(text or "")]
                margin = cache.learn({u for _, us in found for u in us})
                out.append([{"sentence": s, "margin": max((margin[u] for u in us), default=-1.0)} for s, us in found])
            yield pd.Series(out, dtype=object)

    return docs.select("doc_id", F.explode(score("text")).alias("s")).select("doc_id", "s.sentence", "s.margin")
