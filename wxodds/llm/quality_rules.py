"""Host-level quality rules.

Each document is measured by SQL expressions alone.  Rule failures are then counted by host, each
host's failure rates are shrunk with an empirical beta prior (fitted by moments over the hosts), and
the host's verdict is joined back to its documents: a document is kept if it passes the base rules
and its host isn't rejected.

Defined results: a null text has no words; a null host is a host of its own; repeated rows are
measured and counted each; with an empty table the result is empty.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "\x09\x0a\x0b\x0c\x0d\x20"
SYMBOLS = "#*$%&|<>"
WINDOW = 8                      # words in a repeated window
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 100        # symbols for 100 words
MAX_DUP_LINE_PERCENT = 30       # repeated lines in 100 lines with a word
MAX_HOST_RATE = 0.5             # a host whose shrunk rate of one rule exceeds this is rejected
RULES = ("base_failed", "symbols_failed", "lines_failed")


def _bind(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words that lie in an 8-word window found twice or more in the array."""
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        numbered = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        found = _bind(numbered, lambda s: F.array_sort(F.transform(F.filter(
            s, lambda e, k: ((k > 0) & (F.get(s, k - 1)["x"] == e["x"])) |
                            ((k < F.size(s) - 1) & (F.get(s, k + 1)["x"] == e["x"]))), lambda e: e["i"])))
        return _bind(found, lambda at: F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")))["n"])

    repeats = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(
        _bind(hashes, lambda h: _bind(windows(h), repeats)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, host and the counts of each document."""
    text = F.coalesce("text", F.lit(""))
    bare = F.length(F.translate(text, SPACE, ""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(bare > 0, F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    counted = _bind(words, lambda w: F.struct(
        F.size(w).alias("n_words"), _repeated_words(w).alias("n_repeat_words")))
    lined = _bind(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    d = docs.select("doc_id", F.col("source").alias("host"), bare.alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
                    lined.alias("l"), counted.alias("w"))
    return d.select("doc_id", "host", F.col("w.n_words").cast("long").alias("n_words"),
                    F.col("word_chars").cast("long").alias("word_chars"), F.col("n_symbols").cast("long").alias("n_symbols"),
                    (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
                    F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
                    F.col("l.n").cast("long").alias("n_lines"))


def judge(measured: DataFrame) -> DataFrame:
    """The rules that each document fails."""
    return (measured
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .withColumn("symbols_failed", 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"))
            .withColumn("lines_failed", 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))


def host_verdicts(judged: DataFrame) -> DataFrame:
    """host, n_docs, and for each rule the failures and the shrunk rate; `rejected` if any rate is too high.

    The prior of a rule is beta(m * s, (1 - m) * s): m is the mean of the hosts' rates, v their
    variance and s = m * (1 - m) / v - 1, held to [1, 1000] (with v = 0 it is 1000)."""
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.count_if(r).alias(f"n_{r}") for r in RULES])
    rate = lambda r: F.col(f"n_{r}") / F.col("n_docs")
    prior = hosts.agg(*[x for r in RULES for x in (F.avg(rate(r)).alias(f"m_{r}"), F.var_pop(rate(r)).alias(f"v_{r}"))])
    row, shrunk = prior.first(), hosts        # one row of six numbers
    for r in RULES:
        m, v = row[f"m_{r}"] or 0.0, row[f"v_{r}"] or 0.0
        s = min(1000.0, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
        shrunk = shrunk.withColumn(f"rate_{r}", (F.col(f"n_{r}") + m * s) / (F.col("n_docs") + s))
    rejected = F.greatest(*[F.col(f"rate_{r}") for r in RULES]) > MAX_HOST_RATE
    return shrunk.select("host", "n_docs", *[f"n_{r}" for r in RULES], *[f"rate_{r}" for r in RULES],
                         rejected.alias("rejected"))


def apply_rules(judged: DataFrame) -> DataFrame:
    """`judged` with `kept`.  Pass a written table: it is read twice, to count and to decide."""
    v = host_verdicts(judged).select(F.col("host").alias("v_host"), "rejected")
    return (judged.join(v, F.col("host").eqNullSafe(F.col("v_host")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("rejected")).drop("v_host", "rejected"))
