"""MinHash near-dedup: components against all pairs, the pigeonhole guarantee, edge rows."""
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxodds.llm import minhash_join as M


def words(text):
    return re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_set(text):
    w = words(text)
    return {tuple(w[i:i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [plain_set(t) for _, t in rows]
    to = list(range(len(rows)))

    def root(k):
        while to[k] != k:
            k = to[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            to[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def group(r, size, n, edits):
    """A text of n words and `size` near copies of it, each with some words changed."""
    base = [f"w{r.randrange(5000)}" for _ in range(n)]
    out = [base]
    for _ in range(size):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(n)] = f"x{r.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def corpus(seed):
    r = random.Random(seed)
    texts = [t for _ in range(12) for t in group(r, r.randrange(1, 12), r.randrange(4, 120), 8)]
    chain = [f"c{k}" for k in range(60)]           # each links with the next alone
    texts += [" ".join(chain[k:k + 40]) for k in range(0, 20, 2)]
    texts += group(r, 150, 60, 5)                  # more than a block
    common = " ".join(f"p{k}" for k in range(40))  # a passage that many share, none of which link
    texts += [common + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(30)) for _ in range(90)]
    texts += ["one", "One", "two words", "Two  words\n", "two words here", "", " \t ", None, None, "a b c d e", "a b c d e f"]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(7, texts[7]), (7, "same id, another text"), (1000, texts[3]), (-5, texts[20])]
    r.shuffle(rows)
    return rows


def test_against_all_pairs(docs_of):
    rows = corpus(1)
    got = [tuple(r) for r in M.components(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_the_scan_finds_what_leaders_leave(docs_of, monkeypatch):
    """Without any round of leaders, the scan of keys and families joins the same components."""
    monkeypatch.setattr(M, "SALTS", ())
    rows = corpus(2)
    got = [tuple(r) for r in M.components(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_pairs_within_far_positions_always_share_a_key():
    r = np.random.default_rng(1)
    assert M.CHUNKS * (M.ERRORS + 1) > M.FAR and M.POSITIONS % M.CHUNK == 0
    for _ in range(300):
        a = r.integers(0, 2**16, M.POSITIONS).astype(np.uint16)
        b = a.copy()
        at = r.choice(M.POSITIONS, M.FAR, replace=False)
        b[at] ^= r.integers(1, 2**16, M.FAR).astype(np.uint16)
        assert (M.keys(a[None]) == M.keys(b[None])).any() and M.differing(a, b) == M.FAR
    assert len(np.unique(M.keys(a[None]))) == len(M.KEPT)


def test_what_the_threshold_can_miss():
    assert M.miss() < 1e-7
    r = random.Random(3)
    far = []
    for _ in range(200):                               # pairs of sets of Jaccard 0.8
        ids = np.array([r.getrandbits(64) for _ in range(450)], np.uint64)
        far.append(int(M.differing(M.signature(np.sort(ids[:400])), M.signature(np.sort(ids[[*range(360), *range(400, 450)]])))))
    mean = M.POSITIONS * (1 - 360 / 450)
    assert max(far) <= M.FAR and abs(np.mean(far) - mean) < 1


def test_edges(spark, docs_of):
    assert M.components(docs_of([(1, "x")]).limit(0)).count() == 0
    none = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (None, "lone text"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, M.components(none).collect()), key=str)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (None, 1, None), (None, 0, None)], key=str)
    long = "word " * 50_000 + "end"
    got = sorted(map(tuple, M.components(docs_of([(1, long), (2, long.upper())])).collect()))
    assert got == [(1, 2, 1), (2, 2, 1)]


def test_two_sets_of_one_name_stop_the_run(docs_of, monkeypatch):
    df = docs_of([(1, "a b"), (2, "c d")])
    real = M.first_pass
    monkeypatch.setattr(M, "first_pass", lambda docs: real(docs).withColumn("node", F.lit(1).cast("long")))
    with pytest.raises(RuntimeError, match="one 64-bit name"):
        M.components(df)
