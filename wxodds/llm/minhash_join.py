"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A document's set holds the 64-bit hashes of its distinct shingles of SHINGLE words (a shorter text is one
shingle).  Documents of one set are copies: they form a class, and classes (nodes) are joined.  Two sets
link when 100 * intersection >= PERCENT * union.

A set's signature is POSITIONS min-hashes of BITS bits.  Two signatures differ at a position with a
probability of 1 - Jaccard (a little less, since BITS are kept), so linked sets differ at more than FAR
positions with a probability under 1e-7 (`miss`), which is all that the join can lose.

Signatures that differ at FAR positions or fewer are found with certainty: they are cut into CHUNKS chunks,
in one of which such a pair differs at ERRORS positions or fewer, since CHUNKS * (ERRORS + 1) > FAR
(pigeonhole).  Each chunk is indexed under what is left of it without any ERRORS of its positions, so such
a pair meets at one of these keys.

Groups are joined without rows for all of their pairs.  At each key, sets are first held against one
leader (of those that a set meets, the one it meets most often); what links is joined to components.
Only keys that hold several components are then scanned in full, between components: those of THIN sets or
fewer pair by pair, larger ones by families (a leader and all sets that share a key with it) in blocks of
sets, which tell only links.  Every pair is held to FAR and the sizes, and is confirmed on the full sets.

Defined results: a null or empty text, or one without words, has an empty set and no links; rows that
repeat a doc_id keep their own results; null doc_ids give no component id if there are others; ties don't
matter, since leaders are told by a total order and links by counts; texts of any length are read whole; an
empty table gives an empty result; other columns are ignored.  If two different sets share a 64-bit name
the run stops with an error.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.components import components as connected
from wxodds.llm.ngram_join import name, word_hashes
from wxodds.llm.storage import remove, written

SHINGLE, PERCENT = 2, 80
POSITIONS, BITS = 64, 16
CHUNK, ERRORS = 4, 1
CHUNKS = POSITIONS // CHUNK
FAR = CHUNKS * (ERRORS + 1) - 1
SALTS = (1,)                 # of the leaders, in each round
THIN = 16                    # sets of a key whose pairs are told one by one; larger keys go by families
BLOCK, ROOM = 64, 100_000    # sets and shingles of a block, a larger set is alone
BATCH = 16                   # pairs of blocks that a Python worker gets at once
AT_ONCE = 1024               # shingles of a set that are hashed at once
COLUMNS = 1 << 16            # distinct shingles of two blocks that are counted at once

_ODD = np.array([xxhash.xxh3_64_intdigest(b"min%d" % k) | 1 for k in range(POSITIONS)], np.uint64)
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
#: the positions that a key keeps, for each key
KEPT = np.array([[c * CHUNK + p for p in range(CHUNK) if p not in gone]
                 for c in range(CHUNKS) for gone in combinations(range(CHUNK), ERRORS)])


def miss(jaccard: float = PERCENT / 100) -> float:
    """The probability that sets of this similarity differ at more than FAR positions, at most."""
    p = 1 - jaccard
    return sum(comb(POSITIONS, k) * p**k * (1 - p)**(POSITIONS - k) for k in range(FAR + 1, POSITIONS + 1))


# ---- sets and signatures --------------------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """The set of a text, sorted."""
    h = word_hashes(text or "")
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())] if len(h) else [], np.uint64)
    s = h[:n]
    for k in range(1, SHINGLE):
        s = s * _STEP + h[k:n + k]
    return np.unique(_mixed(s))


def signature(tokens: np.ndarray) -> np.ndarray:
    """BITS bits of the least hash of a set, for each of POSITIONS hash functions."""
    least = np.full(POSITIONS, 2**64 - 1, np.uint64)
    for at in range(0, len(tokens), AT_ONCE):
        np.minimum(least, np.multiply.outer(_ODD, tokens[at:at + AT_ONCE]).min(1), out=least)
    return (_mixed(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature (a row): the key's number and the BITS bits of each kept position."""
    out = np.zeros((len(signatures), len(KEPT)), np.uint64)
    for p in range(CHUNK - ERRORS):
        out = (out << np.uint64(BITS)) | signatures[:, KEPT[:, p]].astype(np.uint64)
    return out | (np.arange(len(KEPT), dtype=np.uint64) << np.uint64(BITS * (CHUNK - ERRORS)))


_FIRST = "doc_id long, text_key long, n long, node long, proof long, sig binary"


def first_pass(docs: DataFrame) -> DataFrame:
    """Each document with its set's size, name and signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                tokens = shingles(text)
                rows.append((len(tokens), *name(tokens), signature(tokens).tobytes()))
            made = pd.DataFrame(rows, columns=["n", "node", "proof", "sig"])
            yield pd.concat([batch[["doc_id", "text_key"]].astype("Int64").reset_index(drop=True), made], axis=1)

    return docs.select("doc_id", "text_key", "text").mapInPandas(run, _FIRST)


def postings(owners: DataFrame) -> DataFrame:
    """(key, node): the keys of each set.  Sets of one shingle link with copies alone and have none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = keys(np.frombuffer(b"".join(batch["sig"]), np.uint16).reshape(-1, POSITIONS))
            yield pd.DataFrame({"key": found.ravel().view(np.int64), "node": np.repeat(batch["node"].to_numpy(), len(KEPT))})

    return owners.where("n > 1").select("node", "sig").mapInPandas(run, "key long, node long")


# ---- candidates -----------------------------------------------------------------------------------

def shared_postings(rows: DataFrame) -> DataFrame:
    """The postings of keys that several sets have.  Counts are added up before they are shuffled, and Spark
    splits a hot key of the join."""
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return rows.join(several, "key")


def _mixed_keys(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, node, part): the postings of keys that several components have."""
    rows = shared.join(parts.select("node", "component"), "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("part"))
    rows = written(rows, "parted")
    several = rows.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("key")
    out = written(rows.join(several, "key"), "mixed")
    remove(rows)
    return out


def star_pairs(rows: DataFrame, salt: int) -> DataFrame:
    """(x, y): each set with the leader of another component that it meets most often."""
    leader = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "part")).alias("r"))
    met = rows.join(leader, "key").where("part <> r.part").groupBy("node", F.col("r.node").alias("leader")).agg(F.count(F.lit(1)).alias("c"))
    best = met.groupBy("node").agg(F.max(F.struct("c", "leader")).alias("b"))
    return best.select(F.least("node", "b.leader").alias("x"), F.greatest("node", "b.leader").alias("y")).distinct()


def differing(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The number of positions at which signatures (rows) differ."""
    return (xs != ys).sum(-1)


def near(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """The pairs whose sizes may link and whose signatures differ at FAR positions or fewer."""
    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        rows = [np.frombuffer(b"".join(s), np.uint16).reshape(-1, POSITIONS) for s in (a, b)]
        return pd.Series(differing(*rows) <= FAR)

    side = lambda k: owners.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"s_{k}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").where(f"100 * least(n_x, n_y) >= {PERCENT} * greatest(n_x, n_y)")
    return both.where(close("s_x", "s_y")).select("x", "y")


def thin_pairs(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """(x, y): of keys that THIN sets or fewer have, the pairs of different components whose sizes may link and
    whose signatures differ at FAR positions or fewer; each is told at the first key that both have."""
    told = rows.join(owners.select("node", "n", "sig"), "node")
    members = told.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("node", "n", "part", "sig"))).alias("m"))
    members = members.select("key", *[F.col("m")[c].alias(c) for c in ("node", "n", "part", "sig")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, same in batch.groupby(batch["node"].map(len)):      # keys of one size at once
                if size > 1:
                    yield _thin(size, *(np.stack(same[c].to_numpy()) for c in ("node", "n", "part")),
                                np.frombuffer(b"".join(b"".join(x) for x in same["sig"]), np.uint16).reshape(len(same), size, POSITIONS),
                                same["key"].to_numpy() >> (BITS * (CHUNK - ERRORS)))

    return members.mapInPandas(run, "x long, y long")


def _thin(size: int, node, n, part, sig, number) -> pd.DataFrame:
    """The pairs of keys (rows) of `size` sets each, by the keys' numbers."""
    i, j = np.triu_indices(size, 1)
    may = (part[:, i] != part[:, j]) & (100 * np.minimum(n[:, i], n[:, j]) >= PERCENT * np.maximum(n[:, i], n[:, j]))
    k, p = np.nonzero(may)
    a, b = sig[k, i[p]], sig[k, j[p]]
    close = differing(a, b) <= FAR
    k, p = k[close], p[close]
    first = (keys(a[close]) == keys(b[close])).argmax(1) == number[k]
    k, p = k[first], p[first]
    return pd.DataFrame({"x": node[k, i[p]], "y": node[k, j[p]]})


def _members(sets) -> tuple[list[np.ndarray], np.ndarray]:
    """(node, n, part) and the signatures of a list of sets."""
    return ([np.array([r[c] for r in sets], np.int64) for c in ("node", "n", "part")],
            np.frombuffer(b"".join(r["sig"] for r in sets), np.uint16).reshape(-1, POSITIONS))


def _may_link(n, part, a, m, other, b, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs `where`, those of different components that sizes and signatures let link."""
    where = where & (part[:, None] != other) & (100 * np.minimum(n[:, None], m) >= PERCENT * np.maximum(n[:, None], m))
    i, j = np.nonzero(where)
    close = differing(a[i], b[j]) <= FAR
    return i[close], j[close]


def families(rows: DataFrame) -> DataFrame:
    """(leader, node, leaders): each set with each leader of its keys.  Two sets that share a key are both
    with that key's leader; `leaders` tells at which one they are looked at."""
    leader = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("r"))
    member = rows.join(leader, "key").select("node", F.col("r.node").alias("leader")).distinct()
    all_of = member.groupBy("node").agg(F.array_sort(F.collect_list("leader")).alias("leaders"))     # len(KEPT) at most
    return all_of.select("node", "leaders", F.explode("leaders").alias("leader"))


def family_links(rows: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """(x, y): links between components among sets that share a key, told by their full sets.

    The sets of a family are dealt to blocks of BLOCK sets (or ROOM shingles), and blocks are held against
    each other.  A pair that signatures let link is counted at the least leader that both have, and of the
    links of two blocks only those are told that join components, so the rows don't grow with the pairs."""
    member = written(families(rows), "families")
    parts = rows.select("node", "part").distinct()
    sets = written(_sets(docs, owners, parts.select("node")), "sets")
    sized = member.join(owners.select("node", "n", "sig"), "node")
    size = sized.groupBy("leader").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / ROOM)).alias("blocks"))
    told = (sized.join(parts, "node").join(size, "leader").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .join(sets, "node").groupBy("leader", "block").agg(
                F.min("part").alias("a"), F.max("part").alias("b"),
                F.collect_list(F.struct("node", "n", "part", "sig", "leaders", "tokens")).alias("members")))
    found = written(told, "blocks")
    one, other = (found.select("leader", *[F.col(c).alias(f"{c}_{k}") for c in ("block", "a", "b", "members")]) for k in "xy")
    met = one.join(other, "leader").where("block_x <= block_y and not (a_x = b_x and a_y = b_y and a_x = a_y)")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leader, same, xs, ys in batch.itertuples(index=False):
                yield pd.DataFrame(_block_links(leader, same, xs, ys), columns=["x", "y"])

    out = met.select("leader", F.expr("block_x = block_y").alias("same"), "members_x", "members_y").mapInPandas(run, "x long, y long")
    with _arrow_rows(docs.sparkSession, BATCH):
        out = written(out, "links")
    for table in (member, sets, found):
        remove(table)
    return out


@contextmanager
def _arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Hold Arrow batches to `most` rows meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _block_links(leader: int, same: bool, xs, ys) -> list[tuple[int, int]]:
    (x, n, part), a = _members(xs)
    (y, m, other), b = _members(ys)
    where = x[:, None] < y if same else np.ones((len(x), len(y)), bool)
    lower = [[[h for h in r["leaders"] if h < leader] for r in side] for side in (xs, ys)]
    i, j = _may_link(n, part, a, m, other, b, where & (_common(*([np.array(h, np.int64) for h in side] for side in lower)) == 0))
    if not len(i):
        return []
    rows, columns = np.unique(i), np.unique(j)
    common = np.zeros((len(x), len(y)), np.int64)
    common[np.ix_(rows, columns)] = _common(*([np.frombuffer(side[k]["tokens"], np.uint64) for k in at] for side, at in ((xs, rows), (ys, columns))))
    links = common[i, j] * (100 + PERCENT) >= PERCENT * (n[i] + m[j])
    joined, out = {}, []

    def root(p: int) -> int:
        while (q := joined.get(p, p)) != p:
            p = q
        return p

    for k, c in zip(i[links].tolist(), j[links].tolist(), strict=True):
        p, q = root(int(part[k])), root(int(other[c]))
        if p != q:
            joined[p] = q
            out.append((int(x[k]), int(y[c])))
    return out


def _common(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `xs` shares with each of `ys`, by products of 0/1 columns, of which
    COLUMNS are held at once."""
    of = np.repeat(np.arange(len(xs) + len(ys)), [len(s) for s in [*xs, *ys]])
    token = np.concatenate([*xs, *ys])
    both = np.intersect1d(token[of < len(xs)], token[of >= len(xs)])
    at = np.searchsorted(both, token)
    at[at == len(both)] = 0
    there = both[at] == token if len(both) else np.zeros(len(token), bool)
    of, at = of[there], at[there]
    out = np.zeros((len(xs), len(ys)), np.int64)
    for start in range(0, len(both), COLUMNS):
        some = (at >= start) & (at < start + COLUMNS)
        has = np.zeros((len(xs) + len(ys), min(COLUMNS, len(both) - start)), np.float32)
        has[of[some], at[some] - start] = 1
        out += np.rint(has[:len(xs)] @ has[len(xs):].T).astype(np.int64)
    return out


# ---- links ----------------------------------------------------------------------------------------

def _sets(docs: DataFrame, owners: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its shingles (`tokens`, sorted 64-bit); `owners` has a document of each set."""
    wanted = owners.join(nodes, "node").select("node", F.col("doc_id").alias("w_doc_id"), F.col("text_key").alias("w_text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("text_key") == F.col("w_text_key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "tokens": [shingles(t).tobytes() for t in batch["text"]]})

    # rows that repeat a doc_id and its text give one set each, equal ones
    return docs.join(wanted, same).dropDuplicates(["node"]).select("node", "text").mapInPandas(run, "node long, tokens binary")


def confirmed(docs: DataFrame, owners: DataFrame, pairs: DataFrame) -> DataFrame:
    """(x, y): the pairs that link by their full sets."""
    pairs = written(pairs, "pairs")
    sets = written(_sets(docs, owners, pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()), "sets")

    @F.pandas_udf("long")
    def common(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                          for x, y in zip(xs, ys, strict=True)], dtype=np.int64)

    side = lambda k: sets.select(F.col("node").alias(k), F.col("tokens").alias(f"t_{k}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    size = (F.octet_length("t_x") + F.octet_length("t_y")) / 8
    out = both.select("x", "y", size.alias("size"), common("t_x", "t_y").alias("c")).where(
        F.col("c") * (100 + PERCENT) >= PERCENT * F.col("size")).select("x", "y")
    out = written(out, "links")
    remove(pairs)
    remove(sets)
    return out


def _joined(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """(node, component) of `parts` and more links."""
    edges = found if parts is None else found.unionAll(parts.select(F.col("node").alias("x"), F.col("component").alias("y")))
    return written(connected(edges), "parts")


def components(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, n, and component_id, the least doc_id of all documents that
    links and copies reach; a document with an empty set has its own doc_id."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    members = written(first_pass(keyed), "members")
    classes = members.where("n > 0").groupBy("node").agg(
        F.min("proof").alias("a"), F.max("proof").alias("b"), F.min(F.struct("doc_id", "text_key")).alias("one"),
        F.min("doc_id").alias("least"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    owners = written(classes.select("node", "n", "sig", "one.*", "least", (F.col("a") != F.col("b")).alias("clash")), "owners")
    if owners.where("clash").limit(1).count():
        raise RuntimeError("two different sets have one 64-bit name")
    shared = written(shared_postings(postings(owners)), "shared")
    parts, rows = None, shared.withColumn("part", F.col("node"))
    for salt in SALTS:
        found = confirmed(keyed, owners, near(star_pairs(rows, salt), owners))
        parts = _joined(parts, found)
        rows = _mixed_keys(shared, parts)
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    rows = written(rows.join(several, "key"), "cross")
    found = confirmed(keyed, owners, thin_pairs(rows.where(F.col("c") <= THIN), owners))
    parts = _joined(parts, found.unionAll(family_links(rows.where(F.col("c") > THIN), keyed, owners)))
    of_node = owners.select("node", "least").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least = of_node.groupBy("part").agg(F.min("least").alias("component_id"))
    of_node = of_node.select("node", "part").join(least, "part").select("node", "component_id")
    out = members.join(of_node, "node", "left")
    return out.select("doc_id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
