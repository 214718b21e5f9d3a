"""Exact Jaccard self-join on word shingles, size-aware: heavy and light sets go two ways.

A document's set holds the 64-bit hashes of its distinct shingles of SHINGLE words (a shorter text is
one shingle).  Documents of one set are copies: they form a class, and classes are joined.  Two
sets link when 100 * intersection >= PERCENT * union.

All sets are ordered alike, the corpus's rarest shingles first.  With p = n - ceil(n * PERCENT / 100)
a linked pair shares a shingle among the first p + 1 of each set, and two among the first p + 2
(different sets of fewer than two shingles never link).  So
  - light sets (fewer shingles than a boundary) are keyed by all pairs of their first p + 2 shingles,
  - heavy sets, and the light ones that are large enough to link with one, by each of their first
    p + 1, whose inverted lists are scanned.
The boundary is the size with the least estimated cost, from the sizes and shared shingles met in the
first pass.  The order affects the cost only: shingles in HEAVY_LEAST sets or more rank behind the others, by their
exact counts, held to HEAVY_TOKENS entries by raising the least count to total / HEAVY_TOKENS; equal
ranks go by hash, so the counts of the highest hashes, which prefixes hardly reach, aren't needed.

`components` spares the pairs inside groups that are linked anyway: first every list links its members
to a few representatives, these pairs are verified and joined to components, and only lists that
hold more than one component are then scanned in full, between components, sparing by the triangle
inequality what lies too far from the hub of a group.  `links` gives all links.  Candidates are dropped only by a bound on their overlap, and verified on their whole sets.

Defined results: a null or empty text, or one without words, has an empty set and no links; rows
that repeat a doc_id keep their own results; null doc_ids give no component id if there are others;
ties don't matter, since all orders are total; an empty table gives an empty result; other columns are
ignored.  If two different sets share a 64-bit name the run stops with an error.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxodds.llm.components import components as connected
from wxodds.llm.storage import release, remove, written

SHINGLE, PERCENT = 5, 75
HEAVY_TOKENS, HEAVY_LEAST = 2_000_000, 8
COUNTED = int(0.6 * 2**64)   # shingles with hashes from here on are never counted, see token_rows
LIGHT_MOST = 64              # the boundary is at most this
CHUNK = 500_000            # shingles counted at once in a task
LONG_WORD = 255
LINK_FAR = 1 - PERCENT / 100 + 1e-9      # the distance of a link at most
HOT_KEYS = 62
BLOCK = 64                   # members of a star that are looked at together
SALTS = ((1, 2), (3, 4))     # of the representatives, in each round


# ---- sets -----------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in _LOWER], np.uint64)    # by lower-case letter
_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: the sum of its bytes' values times powers of a base, from one running
    sum over the text.  Words of over LONG_WORD bytes, for which such sums are weak, are hashed whole."""
    data = np.frombuffer(text.encode(), np.uint8)
    edge = np.diff(~_SPACE[data], prepend=False, append=False)
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    room = 1 << max(12, len(data).bit_length())
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, room)[:len(data)], out=total[1:])
    h = _mixed((total[end] - total[start]) * _powers(_UNBASE, room)[start])
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        h[k] = xxhash.xxh3_64_intdigest(_LOWER[data[start[k]:end[k]]].tobytes())
    return h


def shingles(text: str | None) -> np.ndarray:
    """The set of a text, sorted."""
    h = word_hashes(text or "")
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())] if len(h) else [], np.uint64)
    s = h[:n].copy()
    for k in range(1, SHINGLE):
        s *= np.uint64(_BASE)
        s += h[k:n + k]
    return np.unique(_mixed(s))


def name(tokens: np.ndarray) -> tuple[int, int]:
    """A set's 64-bit name and 64 more bits that tell whether names clash."""
    d = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (d >> 64) - 2**63, (d & 2**64 - 1) - 2**63


def least_overlap(n):
    """What a set of n shingles shares at least with one that links."""
    return -(-n * PERCENT // 100)


def profile(tokens: np.ndarray) -> bytes | None:
    """How many shingles fall into each of about n equal ranges; None if a count doesn't fit a byte."""
    bits = max(6, min(16, int(len(tokens)).bit_length()))
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def most_shared(x: bytes, y: bytes) -> int:
    """A bound on what the sets of two profiles share: the sum of the lesser counts."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = a.reshape(len(b), -1).sum(1)
    return int(np.minimum(a, b).sum())


_FIRST = "doc_id long, text_key long, n int, node long, proof long, profile binary, sets long, cost double"


def first_pass(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a document with its set's name and profile; and, for a small size n, the
    number of its sets and the shingles (cost) that they share with others of the chunk."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def costs() -> pd.DataFrame:
            token, df = np.unique(np.concatenate(held), return_counts=True) if held else (None, None)
            out = np.zeros((LIGHT_MOST + 1, 2))
            for s in held:
                others = np.sort(df[np.searchsorted(token, s)] - 1)[:len(s) - least_overlap(len(s)) + 1]
                out[len(s)] += 1, others.sum()
            held.clear()
            small = np.flatnonzero(out[:, 0])
            return _first_frame(pd.DataFrame({"n": small, "sets": out[small, 0].astype(np.int64), "cost": out[small, 1]}))

        for batch in batches:
            rows = []
            for doc_id, key, text in batch.itertuples(index=False):
                tokens = shingles(text)
                node, proof = name(tokens)
                rows.append((doc_id, key, len(tokens), node, proof, profile(tokens)))
                if 1 < len(tokens) <= LIGHT_MOST and node not in seen:
                    seen.add(node)
                    held.append(tokens)
                    size += len(tokens)
            yield _first_frame(pd.DataFrame(rows, columns=["doc_id", "text_key", "n", "node", "proof", "profile"]))
            if size > CHUNK:
                yield costs()
                size = 0
        yield costs()

    return docs.select("doc_id", "text_key", "text").mapInPandas(run, _FIRST)


def _first_frame(part: pd.DataFrame) -> pd.DataFrame:
    out = part.reindex(columns=[c.split()[0] for c in _FIRST.split(", ")])
    whole = [c for c in out.columns if c not in ("cost", "profile")]
    return out.astype({c: "Int32" if c == "n" else "Int64" for c in whole} | {"cost": float, "profile": object})


def token_rows(docs: DataFrame) -> DataFrame:
    """(token, df): the shingles of different sets under COUNTED, counted in chunks of each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for text in batch["text"]:
                tokens = shingles(text)
                node = name(tokens)[0]
                if len(tokens) > 1 and node not in seen:
                    seen.add(node)
                    held.append(tokens[:np.searchsorted(tokens, np.uint64(COUNTED))])
                    size += len(held[-1])
                if size > CHUNK:
                    token, df = np.unique(np.concatenate(held), return_counts=True)
                    yield pd.DataFrame({"token": token.view(np.int64), "df": df})
                    held, size = [], 0
        if held:
            token, df = np.unique(np.concatenate(held), return_counts=True)
            yield pd.DataFrame({"token": token.view(np.int64), "df": df})

    return docs.select("text").mapInPandas(run, "token long, df long")


class Order(NamedTuple):
    """What ranks the shingles, and where light sets end."""
    tokens: np.ndarray       # that repeat much, sorted
    df: np.ndarray
    light: int               # sets of fewer shingles are light

    def first(self, s: np.ndarray, count: int) -> np.ndarray:
        """The first `count` shingles of a set."""
        at = np.searchsorted(self.tokens, s)
        at[at == len(self.tokens)] = 0
        df = np.where(self.tokens[at] == s, self.df[at], 0) if len(self.tokens) else np.zeros(len(s), np.int64)
        return s[np.argsort(df, kind="stable")[:count]] if df.any() else s[:count]


def order_of(first: DataFrame, tokens: DataFrame) -> Order:
    total = first.where("text_key is not null").agg(F.sum("n")).first()[0] or 0
    least = max(HEAVY_LEAST, -(-total // HEAVY_TOKENS))      # at most HEAVY_TOKENS shingles are as frequent
    heavy = tokens.groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= least).toPandas()
    token = heavy["token"].to_numpy(np.int64).astype(np.uint64)
    rank = np.argsort(token)
    chunks = first.rdd.getNumPartitions()
    sizes = {r["n"]: (r["sets"], r["cost"] * chunks) for r in
             first.where("cost is not null").groupBy("n").agg(F.sum("sets").alias("sets"), F.sum("cost").alias("cost")).collect()}
    return Order(token[rank], heavy["df"].to_numpy(np.int64)[rank], boundary(sizes))


def boundary(sizes: dict[int, tuple[int, float]]) -> int:
    """The size from which sets are heavy: the least sum of the rows of light sets (pairs of shingles)
    and the rows and scanned list entries of heavy ones."""
    def cost(light: int) -> float:
        out = 0.0
        for n, (sets, shared) in sizes.items():
            p = n - least_overlap(n)
            if n < light:
                out += sets * (p + 2) * (p + 1) / 2
            if n >= least_overlap(light):
                out += sets * (p + 1) + shared
        return out

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


_POSTINGS = "key long, node long, spot long"
BY_PAIR = 2**31


def postings(docs: DataFrame, order: Order) -> DataFrame:
    """The keys of each set.  `spot` is its size times 2^32, and the shingle's rank in the set, or
    BY_PAIR for a pair of shingles."""
    def keys_of(s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(s)
        p = n - least_overlap(n)
        if n >= least_overlap(order.light):
            yield order.first(s, p + 1), np.arange(p + 1) + (n << 32)
        if n < order.light:
            f = order.first(s, p + 2)
            a, b = np.triu_indices(len(f), 1)
            yield _mixed(f[a] * np.uint64(_BASE) + f[b]), np.full(len(a), (n << 32) + BY_PAIR)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                keys, nodes, spots = [], [], []
                for text in batch["text"].iloc[at:at + 1000]:
                    s = shingles(text)
                    node = name(s)[0]
                    if len(s) < 2 or node in seen:          # a single shingle links with copies alone
                        continue
                    seen.add(node)
                    for key, spot in keys_of(s):
                        keys.append(key)
                        spots.append(spot)
                        nodes.append(node)
                if keys:
                    yield pd.DataFrame({"key": np.concatenate(keys).astype(np.int64), "node": np.repeat(nodes, [len(k) for k in keys]),
                                        "spot": np.concatenate(spots)})

    return docs.select("text").mapInPandas(run, _POSTINGS)


def shared_postings(rows: DataFrame) -> DataFrame:
    """The postings of keys that two or more different sets have, each once, with the key's representatives."""
    per_key = Window.partitionBy("key")
    both = F.min("node").over(per_key) != F.max("node").over(per_key)
    least = lambda salt: F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "n")).over(per_key)
    shared = rows.withColumn("shared", both).where("shared").select(
        "key", "node", F.shiftright("spot", 32).cast("int").alias("n"),
        F.when(F.col("spot").bitwiseAND(BY_PAIR) > 0, -1).otherwise(F.col("spot").bitwiseAND(BY_PAIR - 1)).cast("int").alias("place"))
    return shared.dropDuplicates(["key", "node"]).select("*", *[least(s).alias(f"r{s}") for salts in SALTS for s in salts])


# ---- pairs ----------------------------------------------------------------------------------------

def star_pairs(shared: DataFrame, salts: tuple[int, ...], parts: DataFrame | None = None) -> DataFrame:
    """(x, y): for each set and salt, the representative of another of the `parts` (node, component)
    that it shares most keys with.  These pairs only join large groups early, so weak ones (a third of
    the first shingles of a linked pair would be expected at least) are left to `cross_pairs`, which
    drops none that may link."""
    each = shared.select("node", "n", F.explode(F.array(*[
        F.struct(F.lit(s).alias("salt"), F.col(f"r{s}.node").alias("y"), F.col(f"r{s}.n").alias("m")) for s in salts])).alias("r"))
    fits = "y <> node and 100 * least(n, m) >= %d * greatest(n, m)" % PERCENT
    counted = (each.select("node", "n", "r.*").where(fits).groupBy("node", "n", "salt", "y").agg(F.count(F.lit(1)).alias("c"))
               .where("12 * c >= n"))
    if parts is not None:
        part = lambda k: parts.select(F.col("node").alias(k), F.col("component").alias(f"part_{k}"))
        counted = (counted.join(part("node"), "node", "left").join(part("y"), "y", "left")
                   .where("coalesce(part_node, node) <> coalesce(part_y, y)"))
    best = counted.groupBy("node", "salt").agg(F.max_by("y", F.struct("c", "y")).alias("y"))
    return best.select(F.least("node", "y").alias("x"), F.greatest("node", "y").alias("y")).distinct()


def hubs(found: DataFrame) -> DataFrame:
    """(node, hub, far) for each end of links: its neighbour with the most links, and its distance,
    1 - intersection / union."""
    far = 1 - F.col("common") / (F.col("size") - F.col("common"))
    both = found.select(F.col("x").alias("node"), F.col("y").alias("hub"), far.alias("far")).unionAll(
        found.select(F.col("y").alias("node"), F.col("x").alias("hub"), far.alias("far")))
    degree = both.groupBy("hub").agg(F.count(F.lit(1)).alias("degree"))
    best = both.join(degree, "hub").groupBy("node").agg(F.max_by(F.struct("hub", "far"), F.struct("degree", "hub")).alias("b"))
    return best.select("node", "b.hub", "b.far")


def cross_pairs(shared: DataFrame, owners: DataFrame, parts: DataFrame | None = None, stars: DataFrame | None = None) -> DataFrame:
    """(x, y): sets of different `parts` (node, component), or any, that may link.

    Sets stand in `stars` (node, hub, far) or alone, as their own hubs.  If a set links with one of a star
    it shares a key with it; of two stars, the sets of the smaller are first held against the hub of
    the larger.  The distance of sets is a metric, so a set that is farther from the hub than a link
    may be long plus a member's distance doesn't link with that member.  What is left is held against
    the star's members in blocks, by their profiles, so that no rows of pairs are made."""
    rows = shared.select("key", "node", "n", "place").withColumns({"part": F.col("node"), "hub": F.col("node"), "members": F.lit(1).cast("long")})
    if parts is not None:
        reach = stars.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.max("far").alias("far"))
        own = written(parts.join(stars, "node", "left").join(reach.select("hub", "members"), "hub", "left").select(
            "node", F.col("component").alias("in_part"), F.coalesce("hub", "node").alias("in_hub"),
            F.coalesce("members", F.lit(1)).alias("in_star")), "own")
        rows = rows.join(own, "node", "left").select(
            "key", "node", "n", "place", F.coalesce("in_part", "part").alias("part"), F.coalesce("in_hub", "hub").alias("hub"),
            F.coalesce("in_star", "members").alias("members"))
        mixed = rows.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("key")
        rows = rows.join(mixed, "key")
    rows = written(_with_hot(rows), "cross")
    side = lambda df, k: df.select("key", *[F.col(c).alias(f"{c}_{k}") for c in df.columns if c != "key"])
    spans = rows.groupBy("key", "hub", "part", "members").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("place").alias("place"), F.bit_or("hot").alias("hot"))
    # two sets alone that share several of the hottest keys meet at the first of these only
    near = (side(rows, "x").join(side(spans, "h"), "key")
            .where(f"part_x <> part_h and (members_x < members_h or members_x = members_h and hub_x < hub_h) "
                   f"and 100 * most_h >= {PERCENT} * n_x and 100 * n_x >= {PERCENT} * least_h "
                   f"and (members_h > 1 or below_x < 0 or (hot_x & hot_h & below_x) = 0)")
            .groupBy("node_x", "hub_h").agg(
                F.first("n_x").alias("n"), F.first("least_h").alias("m"), F.max("members_h").alias("members_h"),
                F.sum(F.when(F.col("place_x") < 0, 0).when(F.col("below_x") >= 0, F.bit_count(F.col("hot_x").bitwiseAND(F.col("hot_h"))))
                      .otherwise(1)).alias("c"), F.min("place_x").alias("by_pair")))
    # two sets alone: what they share of their first shingles, and all that stand behind those of one
    behind = lambda n: F.col(n) - (F.floor(F.col(n) * (100 - PERCENT) / 100) + 1)
    most = F.col("c") + F.greatest(behind("n"), behind("m"))
    may = (F.col("members_h") > 1) | (F.col("by_pair") < 0) | ((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("m")))
    near = near.where(may).select(F.col("node_x").alias("x"), F.col("hub_h").alias("hub"))
    if parts is None:
        return _within(near.withColumn("far", F.lit(0.0)), owners).select("x", F.col("hub").alias("y"))
    near = near.join(reach, "hub", "left").withColumn("far", F.coalesce("far", F.lit(0.0)))
    near = written(_within(near, owners), "near")
    alone = near.where("members is null").select("x", F.col("hub").alias("y"))
    return alone.unionAll(_in_blocks(near.where("members is not null"), owners, stars, reach))


def _with_hot(rows: DataFrame) -> DataFrame:
    """`rows` with `hot`, the set's keys among the HOT_KEYS longest lists as bits, and `below`, the bits
    under the row's own key (-1 if that isn't one of them)."""
    longest = rows.where("place >= 0").groupBy("key").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "key").limit(HOT_KEYS).collect()
    keys = rows.sparkSession.createDataFrame([(r["key"], k) for k, r in enumerate(longest)], "key long, bit int")
    marked = rows.join(F.broadcast(keys), "key", "left")          # HOT_KEYS rows
    one = F.expr("shiftleft(1L, bit)")
    at = written(marked.where("bit is not null").withColumn("one", one), "hot")      # masks matter at these keys only
    hot = at.groupBy("node").agg(F.bit_or("one").alias("hot"))
    none = marked.where("bit is null").select(*rows.columns, F.lit(0).cast("long").alias("hot"), F.lit(-1).cast("long").alias("below"))
    return at.join(hot, "node").select(*rows.columns, "hot", (F.col("one") - 1).alias("below")).unionAll(none)


def _within(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows (x, hub, far and more) of which the distance of x and hub may be `far` plus that of a
    link, as far as their profiles tell, with that bound as `closest`."""
    @F.pandas_udf("double")
    def closest(xs: pd.Series, hs: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([_closest(x, h, n) for x, h, n in zip(xs, hs, sizes, strict=True)], dtype=float)

    pairs = written(pairs, "asked")
    ends = pairs.select(F.explode(F.array("x", "hub")).alias("node")).distinct()
    own = written(owners.select("node", "n", "profile").join(ends, "node"), "profiles")     # read twice
    side = lambda k: own.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("profile").alias(f"p_{k}"))
    told = pairs.join(side("x"), "x").join(side("hub"), "hub")
    told = told.withColumn("closest", closest("p_x", "p_hub", F.col("n_x") + F.col("n_hub")))
    return told.select(*pairs.columns, "closest").where(F.col("closest") <= F.col("far") + LINK_FAR)


def _closest(x: bytes | None, y: bytes | None, size: int) -> float:
    """A lower bound of the distance of two sets of `size` shingles together."""
    if x is None or y is None or (most := most_shared(x, y)) >= size - most:
        return 0.0
    return 1 - most / (size - most)


def _in_blocks(near: DataFrame, owners: DataFrame, stars: DataFrame, reach: DataFrame) -> DataFrame:
    """(x, y): x of `near` with those members y of the star that it may link with."""
    n_blocks = reach.select("hub", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    member = stars.join(n_blocks, "hub").join(owners.select("node", "n", "profile"), "node")
    blocks = member.groupBy("hub", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")).agg(
        *[F.collect_list(F.coalesce(F.col(c), F.lit(b"")) if c == "profile" else F.col(c)).alias(f"{c}s") for c in ("node", "n", "profile", "far")])
    asked = (near.select("x", "hub", "closest").join(owners.select(F.col("node").alias("x"), "n", "profile"), "x").join(n_blocks, "hub")
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))

    @F.pandas_udf("array<long>")
    def may_link(n: pd.Series, profile: pd.Series, closest: pd.Series, nodes: pd.Series, ns: pd.Series, profiles: pd.Series,
                 fars: pd.Series) -> pd.Series:
        out = []
        for size, own, least, ys, sizes, theirs, far in zip(n, profile, closest, nodes, ns, profiles, fars, strict=True):
            out.append([int(y) for y, m, p, f in zip(ys, sizes, theirs, far, strict=True)
                        if least <= f + LINK_FAR and 100 * min(size, m) >= PERCENT * max(size, m)
                        and _closest(own, p or None, size + m) <= LINK_FAR])
        return pd.Series(out, dtype=object)

    met = asked.join(blocks, ["hub", "block"]).select("x", may_link(
        "n", "profile", "closest", "nodes", "ns", "profiles", "fars").alias("ys"))
    return met.select("x", F.explode("ys").alias("y")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def fetched_sets(docs: DataFrame, owners: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its shingles (`tokens`, sorted 64-bit), for `nodes`; `owners` has a document of each set."""
    wanted = written(owners.join(nodes, "node").select(
        "node", F.col("doc_id").alias("w_doc_id"), F.col("text_key").alias("w_text_key")), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("text_key") == F.col("w_text_key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            rows = []
            for node, text in batch.itertuples(index=False):
                if node not in seen:
                    seen.add(node)
                    rows.append((node, shingles(text).tobytes()))
            yield pd.DataFrame(rows, columns=["node", "tokens"])

    return docs.join(wanted, same).select("node", "text").mapInPandas(run, "node long, tokens binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, with the size of their intersection."""
    @F.pandas_udf("long")
    def shared(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                          for x, y in zip(xs, ys, strict=True)], dtype=np.int64)

    joined = (pairs.join(sets.select(F.col("node").alias("x"), F.col("tokens").alias("tx")), "x")
              .join(sets.select(F.col("node").alias("y"), F.col("tokens").alias("ty")), "y"))
    size = (F.octet_length("tx") + F.octet_length("ty")) / 8
    return (joined.select("x", "y", size.alias("size"), shared("tx", "ty").alias("common"))
            .where(F.col("common") * (100 + PERCENT) >= PERCENT * F.col("size")).select("x", "y", "common", "size"))


def likely(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """The pairs that link as far as their profiles tell; none that link is dropped."""
    rows = pairs.select("x", F.col("y").alias("hub"), F.lit(0.0).alias("far"))
    return _within(rows, owners).select("x", F.col("hub").alias("y"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()


class _Index(NamedTuple):
    docs: DataFrame          # doc_id, text_key, text
    members: DataFrame       # doc_id, text_key, n, node
    owners: DataFrame        # node, n, profile, doc_id, text_key: one document of each set
    shared: DataFrame


def _index(docs: DataFrame) -> _Index:
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    first = written(first_pass(keyed), "first")
    members = first.where("text_key is not null")
    classes = members.where("n > 0").groupBy("node").agg(
        F.min("proof").alias("a"), F.max("proof").alias("b"), F.min(F.struct("doc_id", "text_key")).alias("one"),
        F.any_value("n").alias("n"), F.any_value("profile").alias("profile"))
    owners = written(classes.select("node", "n", "profile", "one.*", (F.col("a") != F.col("b")).alias("clash")), "owners")
    if owners.where("clash").limit(1).count():
        raise RuntimeError("two different sets have one 64-bit name")
    order = order_of(first, token_rows(keyed))
    release(first)
    shared = written(shared_postings(postings(keyed, order)), "shared")
    release(shared)
    return _Index(keyed, members.select("doc_id", "text_key", "n", "node"), owners.drop("clash"), shared)


def _checked(index: _Index, pairs: DataFrame, have: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The pairs that link, and the sets known so far: `have` and those of further ends."""
    pairs = written(pairs.distinct(), "pairs")
    ends = _ends(pairs)
    sets = written(fetched_sets(index.docs, index.owners, ends if have is None else ends.join(have, "node", "left_anti")), "sets")
    release(sets)
    sets = sets if have is None else sets.unionAll(have)
    found = written(verified(pairs, sets).distinct(), "links")
    remove(pairs)
    release(found)
    return found, sets


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links (x, y, common) between different sets, and the membership (doc_id, text_key, n, node)."""
    index = _index(docs)
    return _checked(index, cross_pairs(index.shared, index.owners))[0], index.members


def _joined(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """(node, component) of `parts` and more links."""
    edges = found.select("x", "y")
    if parts is not None:
        edges = edges.unionAll(parts.select(F.col("node").alias("x"), F.col("component").alias("y")))
    return written(connected(edges), "parts")


def components(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, text_key, n, part (the component's name, null for an empty
    set) and component_id, the least doc_id of all documents that links and copies reach; a document
    with an empty set has its own doc_id."""
    index = _index(docs)
    parts = sets = found = None
    for salts in SALTS:
        near, sets = _checked(index, likely(star_pairs(index.shared, salts, parts), index.owners), sets)
        found = near if found is None else found.unionAll(near)
        parts = _joined(parts, near)
    stars = written(hubs(found), "stars")
    rest, _ = _checked(index, cross_pairs(index.shared, index.owners, parts, stars), sets)
    parts = _joined(parts, rest)
    of_set = index.owners.join(parts, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("part"))
    least = index.members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    of_set = of_set.select("node", "part").join(least, "node")
    part = of_set.groupBy("part").agg(F.min("least").alias("component_id"))
    of_set = written(of_set.join(part, "part").select("node", "part", "component_id"), "sets-parts")
    joined = index.members.join(of_set, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", "n", "part", own.alias("component_id"))
