"""Phrase and proximity matches against brute force on small fixtures."""
import random
import re

from wxodds.llm import decontamination as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - 12, 1) if w else 0):
            grams.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for doc_id, t in docs:
        w, hit, found = words(t), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= ids
        out.append((doc_id, len(w), len(hit), len(found), sorted(map(str, found - {None})), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def fixture(seed):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(12)] + ["Été", "ß"]
    say = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    items = [(i, say(rng.choice((1, 3, 12, 13, 14, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "!!"), (53, "nowhere at all")]
    items.append((54, items[3][1]))
    docs = [(i, say(rng.randint(0, 80))) for i in range(20)] + [(30, None), (31, ""), (32, "...")]
    for k in range(10):
        t = rng.choice(items[:12])[1]
        docs.append((40 + k, f"{say(5)} {t.upper() if k % 2 else t.replace(' ', ', ')} {say(rng.choice((3, 400)))}"))
    return docs + docs[-3:], items


def test_phrases(spark, docs_of):
    for seed in (1, 2):
        docs, items = fixture(seed)
        got = D.decontaminate(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
        got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got.collect()]
        assert sorted(got) == sorted(brute(docs, items))


def test_blocks_and_long_text(spark, docs_of, monkeypatch):
    docs, items = fixture(3)
    docs.append((99, "w1 " * 30_000 + items[5][1]))
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    got = D.decontaminate(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got.collect()}
    want = {r[0]: r[1:4] for r in brute(docs[:-1], items)}
    assert {k: v for k, v in got.items() if k != 99} == want and got[99][0] > 30_000


def test_same_doc_id_with_other_texts_and_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = [(None, "one two three"), (None, "four"), (7, "x one two three y"), (7, "five")]
    got = D.decontaminate(docs_of(docs), items).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in got) == [("7", 0), ("7", 3), ("None", 0), ("None", 3)]
    assert D.decontaminate(docs_of([]), items).count() == 0
    assert [r.contaminated for r in D.decontaminate(docs_of([(1, "a")]), items.limit(0)).collect()] == [False]


def near(docs, items, reach=12):
    """Items of windows whose three rarest different words stand near a place of the rarest, in plain Python."""
    said = {}
    for _, t in docs:
        for w in words(t):
            said[w] = said.get(w, 0) + 1
    out = []
    for doc_id, t in docs:
        w, ids = words(t), set()
        for i, text in items:
            v = words(text)
            for k in range(max(len(v) - 12, 1) if v else 0):
                rare = sorted({x for x in v[k:k + 13] if x in said}, key=lambda x: (said[x], x.encode()))[:3]
                if len(rare) == 3 and any(set(rare) <= set(w[max(p - reach, 0):p + reach + 1]) for p, x in enumerate(w) if x == rare[0]):
                    ids.add(i)
        out.append((doc_id, sorted(map(str, ids))))
    return out


def test_proximity(spark, docs_of):
    items = [(1, "alpha beta gamma"), (2, "beta gamma"), (3, "alpha beta unheard gamma")]
    docs = [(1, "gamma x alpha y beta"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "alpha beta"), (4, "gamma gamma beta alpha")]
    got = D.decontaminate(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.near for r in got} == {1: ["1", "3"], 2: [], 3: [], 4: ["1", "3"]}


def test_proximity_against_brute_force(spark, docs_of):
    for seed in (4, 5):
        docs, items = fixture(seed)
        got = D.decontaminate(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
        assert sorted((r.doc_id, r.near) for r in got) == sorted(near(docs, items))


def test_postings_hold_every_place(spark, docs_of):
    w = D.word_table(docs_of([(1, "b A b c"), (2, None), (None, "a")]))
    posted, looked, _ = D.index(w, spark.createDataFrame([(1, "a b zzz")], "item_id long, text string"))
    assert sorted((str(r.doc_id), r.pos) for r in posted.collect()) == [("1", 0), ("1", 1), ("1", 2), ("None", 0)]
    assert [r.whole for r in looked.collect()] == [False]
