"""Fill-in-middle: the learned index against plain offsets, a plain form of the contract, edge rows."""
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from wxodds.llm import fill_in_middle as M

LETTERS = ["a", "b ", "é", "ß", "漢", "🙂", "\n", "<", "P>"]


def text_of(seed, n):
    r = random.Random(seed)
    return "".join(r.choices(LETTERS, [9, 5, 2, 1, r.random() * 9, r.random() * 3, 1, 1, 1], k=n))


def plain(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", t, None, None
    if h4 % 100 < 20:
        return len(t), "spm", f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}", a, b - a
    return len(t), "psm", f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", a, b - a


def test_each_boundary_is_found_and_each_line_keeps_its_error():
    mixed = ["x" * 50_000, "漢" * 50_000, text_of(1, 80_000), "", "a" * 9_000 + "🙂" * 9_000 + "a" * 9_000]
    for text in [*mixed, "".join(mixed)]:
        y = M.boundaries(np.frombuffer(text.encode(), np.uint8))
        want = np.cumsum([0, *(len(c.encode()) for c in text)])
        assert (y == want).all()
        index = M.fit(y)
        ranks = np.arange(len(y))
        assert (index.offsets(ranks) == want).all()
        assert np.abs(want - index.predicted(ranks)).max() <= M.ERROR + 1
    assert len(M.fit(M.boundaries(np.full(1_000_000, 97, np.uint8))).first) == 1


def test_against_a_plain_form(docs_of):
    rows = [(k, text_of(k, 1 + k * 7 % 900)) for k in range(400)]
    rows += [(500, None), (501, ""), (502, "has <P> inside"), (503, "<M>"), (504, "x"), (505, "<"), (5, "again, another text"), (5, "again, another text"),
             (506, "é" * 300_000), (-1, "negative")]
    out = M.transform(docs_of(rows)).select("doc_id", "n", "form", "output", "prefix_chars", "middle_chars",
                                            M.restore(F.col("output"), F.col("form")).alias("back"), "text")
    got = [tuple(r) for r in out.collect()]
    want = [(i, *plain(i, t), t or "", t) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_edges(spark, docs_of):
    clash = docs_of([(1, "some words here")]).withColumn("form", F.lit("own")).withColumn("n", F.lit("own"))
    out = M.transform(clash)
    assert out.columns.count("form") == 1 and {"node", "text_key", "lang"} <= set(out.columns)
    assert out.first()["n"] == 15
    assert M.transform(docs_of([(1, "x")]).limit(0)).count() == 0
    none = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id long, text string")
    assert sorted((r.n, M.restored(r.output, r.form)) for r in M.transform(none).collect()) == [(0, ""), (9, "some text")]
