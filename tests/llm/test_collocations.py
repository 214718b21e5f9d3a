"""Collocations against a plain count of every phrase."""
import random
import re
from collections import Counter

import pytest

from wxodds.llm import collocations as C


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    held = {}
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                held[lang, p[i:i + k]] = max(a, held.get((lang, p[i:i + k]), 0))
    out = []
    for (lang, p), a in candidates.items():
        if held.get((lang, p), 0) < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, l, r, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    place = Counter()
    ranks = []
    for r in out:
        place[r[0]] += 1
        ranks.append((r[0], place[r[0]], *r[1:]))
    return [r for r in ranks if r[1] <= top]


def texts(seed, n=150):
    r = random.Random(seed)
    vocabulary = ["the", "of", "Is", "onhe", "ünd", "漢字", "x\x1fy", "<br>", "New", "york", "city", "hall", "a", "A", "\x00"]
    fixed = ["new york city hall opens", "is onhe is onhe is onhe", "the of the of, the of", "a a a a a a"]
    out = []
    for _ in range(n):
        w = [r.choice(vocabulary) if r.random() < .7 else r.choice(fixed) for _ in range(r.randrange(60))]
        out.append((r.choice(["en", "en", "fr", None, "und", ""]), "".join(x + r.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " "]) for x in w)))
    return out


def df_of(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "p", 2) for lang, text in rows], "lang string, text string, f long, phrase string, k long").repartition(3)


@pytest.mark.parametrize("least, run", [(3, 4_000_000), (20, 50)])
def test_against_brute_force(spark, least, run):
    for seed in (1, 2):
        rows = [*texts(seed), ("en", None), (None, None), ("en", ""), ("fr", " \t . "), ("en", "the " * 20_000)]
        got = C.ranked(C.collocations(df_of(spark, rows), least, run=run), 60)
        cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(brute(rows, least, 60))


def test_a_full_sieve_changes_nothing(spark):
    rows = texts(3, 60)
    want = sorted(map(tuple, C.collocations(df_of(spark, rows), 5).collect()))
    assert sorted(map(tuple, C.collocations(df_of(spark, rows), 5, 64).collect())) == want and want


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of 10^13 and more, as a large corpus has: scores stay exact."""
    a, n, l, r = 3 * 10**12 + 1, 10**16 + 7, 4 * 10**12 + 3, 10**13 + 9
    found = spark.createDataFrame([("en", "", n), ("en", "x", l), ("en", "y", r), ("en", "x y", a)], "lang string, phrase string, f long")
    monkeypatch.setattr(C, "sieve", lambda *_: None)
    monkeypatch.setattr(C, "counts", lambda *_: found)
    row, = C.collocations(df_of(spark, [])).collect()
    assert row.score == 1000 * a * n // (l * r) and (row.a, row.l, row.r, row.n) == (a, l, r, n)


def test_merges_run_over_ranges_without_another_exchange(spark):
    asks = spark.createDataFrame([("en", "a b", "a")], "lang string, phrase string, key string")
    stream = spark.createDataFrame([("en", "a", 7)], "lang string, key string, f long")
    out = C.lockstep(asks, stream, "l")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan and "Join" not in plan
    assert [tuple(r) for r in out.collect()] == [("en", "a b", "a", 7)]


def test_empty_table(spark):
    assert C.ranked(C.collocations(df_of(spark, []))).count() == 0
