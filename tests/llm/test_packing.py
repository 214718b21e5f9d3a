"""Exact round trip of ids, valid packings, the genetic steps and edge rows."""
import random
import zlib

import numpy as np
import pytest

from wxodds.llm import packing as P

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.default_tokenizer())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_ids_of_chunks_equal_those_of_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHE_CHUNKS", 300)          # so that both are cleared, too
    monkeypatch.setattr(P, "CACHE_WORDS", 200)
    tokens, rng = P.Tokens(P.default_tokenizer()), random.Random(5)
    parts = [*"aabcdeZéÉIİſßΣσ12'`’.,!?;:<|> \n\t\rÀÖ×÷øÿªºµ\x85\xa0́A", "<|endoftext|>", " word", "don't", " ! ", "long" * 20]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert tokens(text) + P.CLOSING == ids_of(tokenizer, text).tobytes(), text


def test_words_need_no_run_of_the_whole_tokenizer(tokenizer, monkeypatch):
    rng = random.Random(6)
    letters = [c for c in map(chr, range(65, 256)) if P._WORD.fullmatch(c)]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) + rng.choice(["", ".", "%%%", "$#!"]) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=20)) for _ in range(300)] + ["", "x" * 100_000, " "]
    tokens, encoded = P.Tokens(P.default_tokenizer()), []
    plain = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda chunks: encoded.extend(chunks) or plain(chunks))
    some = list(P._some(enumerate(texts)))
    assert [i for rows in some for i, _ in rows] == list(range(len(texts))) and len(some) < len(texts) / 4
    got = [ids for rows in some for ids in tokens.many([t for _, t in rows])]
    assert [g + P.CLOSING for g in got] == [ids_of(tokenizer, t).tobytes() for t in texts]
    assert sorted(encoded) == sorted([".", "%%%", "$#!", "x" * 100_000])


def check(rows, docs, tokenizer):
    want = {}
    for i, t in docs:
        ids = ids_of(tokenizer, t)
        for k in range(0, len(ids), P.CAPACITY):
            part = ids[k:k + P.CAPACITY]
            want.setdefault((i, k // P.CAPACITY, k, len(part), zlib.crc32(part.tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    return len(bins), -(-sum(r.length for r in rows) // P.CAPACITY)


def test_pack(spark, docs_of, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 64)                  # several shards, so that remainders meet
    rng = random.Random(1)
    docs = [(i, "word " * rng.choice((rng.randint(1, 400), rng.randint(1, 1500), 5000))) for i in range(250)]
    docs += [(900, None), (901, ""), (902, "a " * 2047), (903, "a " * 2048), (904, "é " * 50_000), (5, "again"), (5, "again"), (None, "x")]
    packed = P.pack(P.pieces(docs_of(docs)).drop("ids"))
    rows = packed.collect()
    used, least = check(rows, docs, tokenizer)
    sizes = sorted((r.length for r in rows), reverse=True)
    assert least <= used <= max(1.02 * least + 1, P._packing(sizes, range(len(sizes))).max() + 2)


def test_sequences_hold_the_ids(spark, docs_of, tokenizer):
    docs = [(1, "one two"), (2, "three"), (3, "word " * 3000)]
    packed = P.pack(P.pieces(docs_of(docs), with_ids=True))
    whole = b"".join(bytes(r.ids) for r in P.sequences(packed).collect())
    assert len(whole) == 4 * sum(len(ids_of(tokenizer, t)) for _, t in docs)


def test_pieces_alone_in_their_sequences_have_one_each(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 64)                  # some shards get more than 64 pieces, and so as many sequences
    packed = P.pack(spark.range(1000).selectExpr("id", "1500L AS length")).collect()
    assert len({r.sequence_id for r in packed}) == 1000 == len({r.id for r in packed})
    assert {r.offset for r in packed} == {0}


def test_empty_and_own_columns(spark, docs_of):
    assert P.pack(P.pieces(docs_of([])).drop("ids")).count() == 0
    df = spark.createDataFrame([(5, 9, 9, 9), (7, 9, 9, 9)], "length long, number long, shard long, sequence_id long")
    assert sorted((r.length, r.number, r.shard) for r in P.pack(df).collect()) == [(5, 9, 9), (7, 9, 9)]


def test_genetic_steps():
    rng = random.Random(4)
    sizes = [rng.randint(1, 1400) for _ in range(400)]
    lengths = np.array(sizes)
    falling = sorted(range(400), key=lambda i: -sizes[i])
    first = P._packing(sizes, falling)
    mixed = P._packing(sizes, rng.sample(range(400), 400))
    child = P.crossover(lengths, sizes, mixed, first, rng)
    for p in (first, mixed, child):
        assert np.bincount(p, lengths).max() <= P.CAPACITY and set(p.tolist()) == set(range(p.max() + 1)) and len(p) == 400
    best = P.evolve(lengths, [mixed], 3)
    assert best[0].max() <= first.max()
    assert [x.tolist() for x in P.evolve(lengths, [mixed], 3)] == [x.tolist() for x in best]
