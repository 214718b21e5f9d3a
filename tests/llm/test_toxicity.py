"""The kernel against its definition, held-out accuracy, obfuscated insults and edge rows."""
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxodds.llm import toxicity as T


def kernel_features(word):
    out = {}
    for a, b, c in combinations(range(len(word)), 3):
        if c - a < T.SPAN and all(word[k].isalpha() for k in (a, b, c)):
            key = word[a] + word[b] + word[c]
            out[key] = out.get(key, 0) + T.DECAY ** (c - a + 1 - T.LENGTH)
    return out


def plain_kernel(s, t):
    a, b = kernel_features(s), kernel_features(t)
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b)) if a and b else 0.0


def test_kernel():
    words = ["idiot", "i.d.i.o.t", "id-iot", "banana", "moron", "ab", "the", "aaaaa"]
    row, feature, value, _ = T.features(words)
    x = np.zeros((len(words), T.SIZE))
    x[row, feature] = value
    got = x @ x.T
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert got[i, j] == pytest.approx(plain_kernel(s, t)), (s, t)


def table(n=900):
    rng = np.random.default_rng(3)
    part = ["an", "the", "ing", "re", "on", "er", "ha", "st"]
    word = lambda: "".join(rng.choice(part, rng.integers(1, 4)))
    say = lambda k: " ".join(word() for _ in range(k)) + "."
    rows, labels = [], []
    for i in range(n):
        text = " ".join(say(int(rng.integers(4, 12))) for _ in range(int(rng.integers(1, 8))))
        toxic = i % 4 == 0
        if toxic:
            text = text.replace(" ", f" {rng.choice(['zwickel', 'vogpum', 'quakbold'])} ", 1)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_inserted_characters(spark, docs_of):
    rows, labels = table()
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = docs_of(rows + [(5000, None), (5001, ""), (5002, "re re. zw-ickel on."), (5003, "st q.u.a.k.b.o.l.d er"),
                           (5004, "vog*pum"), (5005, "x" * 50_000 + " the on")])
    model = T.fit(docs, known.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    score = {r.doc_id: r.toxicity for r in T.scored(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((score[i] >= T.THRESHOLD) == (labels[i][1] == 1) for i in held)
    assert right >= 0.97 * len(held)
    assert score[5000] == score[5001] < 0.5 and score[5005] < 0.5
    assert min(score[5002], score[5003], score[5004]) >= 0.5
    assert all(0 <= s <= 1 for s in score.values())
    worst = T.scored_sentences(docs.where("doc_id = 5002"), model).orderBy(F.desc("margin")).first()
    assert worst.sentence.startswith("zw-ickel")


def test_without_labels_of_a_class(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (None, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for labels in (none, one):
        model = T.fit(docs, labels)
        assert all(r.toxicity < 0.01 for r in T.scored(docs, model).collect())
    assert T.scored(docs_of([]), model).count() == 0
