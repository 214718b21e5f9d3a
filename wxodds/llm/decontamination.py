"""Benchmark decontamination with a distributed positional index, in SQL expressions alone.

`postings` stores term, document and place of every corpus word that the benchmark has, once; counts and
matches are read from there.  Every window of 13 item words (a shorter item is one window) is looked up
from its rarest words, counted over the whole corpus: the lists of its up to three rarest terms are met
document by document, in the order of places.  Where each list, moved back by its term's offset, holds
the same start, the window may stand; only then are the words of that document cut at these starts and
the whole phrase compared.  Where the lists meet within REACH words in any order and at any offsets,
the window has a proximity match, which tells of shuffled or edited copies.

The benchmark is a query set: it is looked up in blocks, each broadcast and at most BLOCK_BYTES
large by count, so that a larger benchmark costs more passes and no more memory.

Defined results: a null text, or one without words, has no words and no hits; an item without words
has no window; a window with fewer than three different words that the corpus has is found as a phrase
only, and one with a word that the corpus lacks by proximity only; terms of equal count rank by their bytes; rows are matched
by doc_id and text together, so rows that repeat a doc_id keep their own results, and rows that repeat both have the same;
a null doc_id or item_id is a value like any other (a null item_id is left out of the list of items); texts of any
length are taken whole; empty tables give empty or hitless results; other columns are ignored.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxodds.llm.storage import written

WINDOW = 13
REACH = WINDOW - 1      # words between two places that are near
RAREST = 3              # terms of a window whose lists are met
BLOCK_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ("doc_id", "text_key")


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def word_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, words; one row for each row of `docs`."""
    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    return d.select(*KEY, F.size("words").cast("long").alias("n_words"), "words")


def postings(words: DataFrame, terms: DataFrame) -> DataFrame:
    """term_id, doc_id, text_key, pos: where each of `terms` (a written table of term_id and term) stands."""
    said = words.select(*KEY, F.posexplode("words").alias("pos", "term"))
    return _union([said.join(F.broadcast(b), "term").select("term_id", *KEY, "pos")
                   for b in _blocks(terms, F.octet_length("term") + 40, F.col("term_id"))])


def windows(items: DataFrame) -> DataFrame:
    """item_id and `phrase` (array of words) of each window of each item."""
    w = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    return (w.select("item_id", "words", F.explode(starts).alias("at"))
            .select("item_id", F.slice("words", F.col("at"), F.lit(WINDOW)).alias("phrase")).distinct())


def _blocks(df: DataFrame, size: Column, key: Column) -> list[DataFrame]:
    """`df` (a written table) in parts of about BLOCK_BYTES at most."""
    total = df.agg(F.sum(size)).first()[0] or 0
    n = 1 + total * 5 // 4 // BLOCK_BYTES
    return [df.where(F.pmod(key, F.lit(n)) == i) for i in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def lookups(phrases: DataFrame, counted: DataFrame) -> DataFrame:
    """Of each phrase: `rare`, its RAREST different words that the corpus has from the rarest (term_id and first
    offset), and whether the corpus has all its words.  `counted` holds term, term_id and n."""
    each = phrases.select("phrase", F.posexplode("phrase").alias("offset", "term")).join(counted, "term")
    each = each.groupBy("phrase", "term", "term_id", "n").agg(F.min("offset").alias("offset"))
    ranked = each.groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("n", "term", "term_id", "offset"))).alias("r"))
    rare = F.transform(F.slice("r", 1, RAREST), lambda x: F.struct(x["term_id"].alias("term_id"), x["offset"].alias("offset")))
    return ranked.select("phrase", F.xxhash64("phrase").alias("phrase_key"), rare.alias("rare"),
                         (F.size("r") == F.size(F.array_distinct("phrase"))).alias("whole"))


def index(words: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, lookups, item windows) as written tables."""
    found = written(windows(items), "windows")
    terms = found.select(F.explode("phrase").alias("term")).distinct()
    terms = written(terms.withColumn("term_id", F.monotonically_increasing_id()), "terms")
    posted = written(postings(words, terms), "postings")
    counted = posted.groupBy("term_id").agg(F.count(F.lit(1)).alias("n")).join(terms, "term_id")
    return posted, written(lookups(found.select("phrase").distinct(), counted), "lookups"), found


def meetings(posted: DataFrame, looked: DataFrame) -> DataFrame:
    """doc_id, text_key, start, length, phrase_key, exact, near: where the lists of a window's rarest terms
    meet at its own offsets (exact: the window may start there) or within REACH words (near)."""
    terms = written(looked.select(F.explode("rare.term_id").alias("term_id")).distinct(), "rarest")
    lists = _union([posted.join(F.broadcast(b), "term_id") for b in _blocks(terms, F.lit(40), F.col("term_id"))])
    reach = Window.partitionBy(*KEY).orderBy("pos").rangeBetween(-REACH, REACH)
    lists = lists.repartition(*KEY).distinct().withColumn("around", F.collect_list(F.struct("term_id", "pos")).over(reach))
    first = F.col("rare")[0]
    others = F.transform(F.slice("rare", 2, RAREST), lambda x: F.struct(
        x["term_id"].alias("term_id"), (x["offset"] - first["offset"]).alias("after")))
    sought = looked.select(first["term_id"].alias("term_id"), others.alias("others"), F.struct(
        "phrase_key", first["offset"].alias("offset"), F.size("phrase").alias("length"), "whole").alias("window"))
    sought = written(sought.groupBy("term_id", "others").agg(F.collect_list("window").alias("windows")), "sought")
    stands = lambda same: F.forall("others", lambda o: F.exists("around", lambda x: (x["term_id"] == o["term_id"]) & same(x, o)))
    exact = stands(lambda x, o: x["pos"] == F.col("pos") + o["after"])
    near = (F.size("others") == RAREST - 1) & stands(lambda x, o: F.lit(True))
    met = _union([lists.join(F.broadcast(b), "term_id").select(*KEY, "pos", "windows", exact.alias("exact"), near.alias("near"))
                  for b in _blocks(sought, 100 + 50 * F.size("windows"), F.xxhash64("term_id", "others"))])
    met = met.where("exact or near").select(*KEY, "pos", "exact", "near", F.explode("windows").alias("w"))
    start = F.col("pos") - F.col("w.offset")
    return met.select(*KEY, start.alias("start"), "w.length", "w.phrase_key",
                      (F.col("exact") & F.col("w.whole") & (start >= 0)).alias("exact"), "near").where("exact or near")


def phrase_matches(docs: DataFrame, met: DataFrame, looked: DataFrame) -> DataFrame:
    """doc_id, text_key, start, length, phrase_key of each occurrence of a window: the words at the starts of
    `met` (a written table) are compared with the whole phrase.  `docs` are met by sort-merge at every size
    and as raw text, which takes less room in a shuffle than its words do."""
    starts = met.where("exact").groupBy(*KEY).agg(F.collect_set(F.struct("start", "length")).alias("starts"))
    starts = starts.withColumnsRenamed({k: f"m_{k}" for k in KEY})
    said = F.transform("starts", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"),
                                                    F.slice("words", s["start"] + 1, s["length"]).alias("phrase")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").hint("merge")
    said = (texts.join(starts, _same("m_")).select(*KEY, "starts", words_of(F.col("text")).alias("words"))
            .select(*KEY, F.explode(said).alias("s")).select(*KEY, "s.*"))
    return _union([said.join(F.broadcast(b.select("phrase", "phrase_key")), "phrase").select(*KEY, "start", "length", "phrase_key")
                   for b in _blocks(looked, 2 * F.octet_length(F.array_join("phrase", " ")) + 200, F.col("phrase_key"))]).distinct()


def proximity_matches(met: DataFrame) -> DataFrame:
    """doc_id, text_key, phrase_key of the windows whose RAREST rarest words stand within REACH words of a place
    of the rarest, in any order."""
    return met.where("near").select(*KEY, "phrase_key").distinct()


def _same(prefix: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id")) & (F.col("text_key") == F.col(f"{prefix}text_key"))


def items_of(matches: DataFrame, found: DataFrame, name: str, prefix: str) -> DataFrame:
    """The items, sorted as strings, of the windows that match in each document."""
    windows_ = found.select("item_id", F.xxhash64("phrase").alias("phrase_key"))
    out = (matches.select(*KEY, "phrase_key").distinct().join(windows_, "phrase_key")
           .groupBy(*KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias(name)))
    return out.withColumnsRenamed({k: f"{prefix}{k}" for k in KEY})


def hit_words(matches: DataFrame) -> DataFrame:
    """n_hit by document: words that any match covers, each counted once."""
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select(*KEY, "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    done = F.coalesce(F.max("end").over(before), F.lit(0))
    new = spans.withColumn("new", F.greatest(F.col("end") - F.greatest("start", done), F.lit(0)))
    return new.groupBy(*KEY).agg(F.sum("new").cast("long").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, text_key, n_words, n_hit, n_items, items (sorted as
    strings), near (the items of proximity matches) and contaminated (a hit, and hit words at least a
    twentieth of all words)."""
    words = word_table(docs)
    posted, looked, found = index(words, items)
    met = written(meetings(posted, looked), "meetings")
    matches = written(phrase_matches(docs, met, looked), "matches")
    hits = hit_words(matches).withColumnsRenamed({k: f"h_{k}" for k in KEY})
    out = (words.drop("words").join(hits, _same("h_"), "left")
           .join(items_of(matches, found, "items", "i_"), _same("i_"), "left")
           .join(items_of(proximity_matches(met), found, "near", "p_"), _same("p_"), "left"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    none = F.array().cast("array<string>")
    items_ = F.coalesce("items", none)
    return out.select(*KEY, "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"), items_.alias("items"),
                      F.coalesce("near", none).alias("near"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))
