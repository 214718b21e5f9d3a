"""Suffix order and removed bytes against brute force."""
import collections
import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from wxodds.llm import suffix_dedup as S

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + S.LENGTH] for d in data for i in range(len(d) - S.LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - S.LENGTH + 1):
            if count[d[i:i + S.LENGTH]] > 1:
                gone[i:i + S.LENGTH] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_two_stage_order():
    rng = random.Random(0)
    for k in range(400):
        text = "".join(rng.choice(rng.choice(["ab", "abc", "a", "abcdefgh"])) for _ in range(rng.randint(1, 60))).encode()
        wanted = np.array([k % 2 or rng.random() < 0.7 for _ in text], bool)
        got = [p for p in S.two_stage_order(text, wanted).tolist() if wanted[p]]
        full = text + b"\x00\xff"
        assert [full[p:] for p in got] == sorted(full[p:] for p in np.flatnonzero(wanted))


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(900)) for _ in range(5)]
    out = [None, "", "x" * 2000, "ab" * 900, "ab" * 900, "x" * 399, "x" * 400, "é" * 300]
    for _ in range(50):
        b, a = rng.choice(base), rng.randint(0, 500)
        out.append("".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 300))) + b[a:a + rng.randint(300, 500)]
                   + rng.choice(["", "q", rng.choice(base)]))
    return out


@pytest.mark.parametrize("hot", [5_000, 0])
def test_removed_bytes(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = list(enumerate(texts(5))) + [(None, "ab" * 300)]
    rows += rows[20:24]                                   # repeated rows are copies of each other
    got = S.dedup(docs_of(rows)).select("doc_id", *COLUMNS).collect()
    want = [(r[0], *w) for r, w in zip(rows, brute([t for _, t in rows]), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_long_text_in_segments(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 1000)
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, a), (2, "zz" + a[3000:8000]), (3, a[:100])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(docs_of(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute([t for _, t in rows])


def test_empty(spark, docs_of):
    assert S.dedup(docs_of([])).count() == 0


def _pieces(texts_):
    return pd.DataFrame({"text": texts_, "wanted": [[{"gram": k, "bytes_a": 1, "bytes_b": 2, "n_starts": 3, "start": s, "hot": False} for s in (0, 5)]
                                                    for k in range(len(texts_))]})


def test_fragments_of_many_texts_are_handed_over_together(monkeypatch):
    data = ["é" + "".join(random.Random(k).choice("abc") for _ in range(900)) for k in range(300)]
    batches = [_pieces(data[:100]), _pieces(data[100:])]
    frames = list(S.cut_out(iter(batches)))
    want = [d.encode()[s:s + S.LENGTH + 2] for d in data for s in (0, 5)]
    assert len(frames) == 1 and frames[0]["bytes"].tolist() == want
    monkeypatch.setattr(S, "HANDED", 10_000)
    frames = list(S.cut_out(iter(batches)))
    assert max(f["bytes"].map(len).sum() for f in frames) <= 10_000 + S.LENGTH + 2
    assert [b for f in frames for b in f["bytes"]] == want
    strings = list(S.hashed_strings(iter(frames)))
    assert len(strings) < len(frames) * 30 and [len(b) for f in strings for b in f["string"]] == [16] * 3 * len(want)
    assert [k for f in strings for k in f["k"]] == [0, 1, 2] * len(want)
