"""Measures against plain Python on odd texts, host verdicts, and edge rows."""
import random
import re

from pyspark.sql import functions as F

from wxodds.llm import quality_rules as Q


def measured(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_measures(spark, docs_of):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "\x0b", "a", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 50, "x\n" * 9, "|<>#\n\n", "é\x85ü b\xa0c"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", " ", " ", "\n", "*", "\t", "a b c d e f g h "]) for _ in range(rng.randint(0, 60))))
    texts.append("w1 w2 w3 " * 20_000)
    rows = {r.doc_id: r for r in Q.measure(docs_of(enumerate(texts))).collect()}
    for i, t in enumerate(texts[:-1]):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measured(t), repr(t)
    assert rows[len(texts) - 1].n_repeat_words == 60_000


def test_host_verdicts(spark):
    good = " ".join(f"word{k}" for k in range(30))
    rows = [(i, good, "good") for i in range(200)] + [(1000 + i, "too short", "bad") for i in range(200)]
    rows += [(2000, good, "bad"), (3000, good, None), (3001, "short", None), (4000, good, "one"), (4001, "short", "few"), (4001, "short", "few")]
    judged = Q.judge(Q.measure(spark.createDataFrame(rows, "doc_id long, text string, source string"))).cache()
    kept = {r.doc_id: r.kept for r in Q.apply_rules(judged).collect()}
    assert all(kept[i] for i in range(200)) and kept[4000] and kept[3000]
    assert not kept[2000] and not kept[1000] and not kept[3001]      # the host's verdict; the base rules
    assert Q.apply_rules(judged).count() == len(rows)
    empty = judged.where(F.lit(False))
    assert Q.apply_rules(empty).count() == 0


def test_shrinking(spark):
    rows = [("a", f) for f in [True] * 2] + [("b", f) for f in [False] * 500] + [("c", f) for f in [True] * 10 + [False] * 490]
    df = spark.createDataFrame(rows, "host string, base_failed boolean").withColumns(
        {"symbols_failed": F.lit(False), "lines_failed": F.lit(False)})
    rate = {r.host: r.rate_base_failed for r in Q.host_verdicts(df).collect()}
    assert rate["b"] < rate["c"] < 0.05 < rate["a"] < 1
