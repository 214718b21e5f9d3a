"""Components and links against all pairs, light and heavy ways, and edge rows."""
import collections
import random
import re

import pytest

from wxodds.llm import ngram_join as N
from wxodds.llm.components import components


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    sets, links = sets_of(rows), set()
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                group[top(i)] = top(j)
                if a != b:
                    links.add(frozenset((a, b)))
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[top(k)].append(i)
    return sorted((i, len(sets[k]), min(least[top(k)])) for k, (i, _) in enumerate(rows)), len(links)


def rows(seed):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(40)] + ["É", "é"]
    out = [(0, None), (1, ""), (2, "a b"), (3, "A \x0b b"), (4, "a b c"), (5, " \n ")]
    base = [[rng.choice(voc) for _ in range(rng.choice((5, 6, 7, 8, 9, 12, 20, 30, 60, 200)))] for _ in range(40)]
    common = [rng.choice(voc) for _ in range(30)]
    for i in range(6, 220):
        b = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(b))
            b[k:k + rng.randint(0, 1)] = [rng.choice(voc)] * rng.randint(0, 2)
        out.append((i, " ".join(b + common if rng.random() < 0.2 else b)))
    return out


@pytest.mark.parametrize("light", [0, 7, 40, 64])
def test_against_all_pairs(spark, docs_of, monkeypatch, light):
    monkeypatch.setattr(N, "boundary", lambda sizes: light)
    monkeypatch.setattr(N, "HEAVY_LEAST", 3)
    data = rows(light)
    want, n_links = brute(data)
    got = N.components(docs_of(data)).select("doc_id", "n", "component_id").collect()
    assert sorted(map(tuple, got)) == want
    assert N.links(docs_of(data))[0].count() == n_links


def test_chains_and_large_groups(spark, docs_of):
    words = [f"v{k}" for k in range(400)]
    data = [(i, " ".join(words[2 * i:2 * i + 60])) for i in range(150)]         # each links with the next few alone
    data += [(1000 + i, " ".join(words[:50]) + f" x{i}") for i in range(300)]
    got = N.components(docs_of(data)).select("doc_id", "n", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(data)[0]


def test_boundary_follows_the_cost():
    assert N.boundary({}) == 0
    assert N.boundary({10: (100, 1e9)}) > 10
    assert N.boundary({60: (1000, 10.0)}) <= 60


def test_edges(spark, docs_of):
    assert N.components(docs_of([])).count() == 0
    data = [(None, "a b c d e f"), (None, "other words"), (3, "a b c d e f"), (3, "quite another text of words"), (4, "x " * 50_000), (3, "a b c d e f")]
    got = N.components(docs_of(data)).select("doc_id", "n", "component_id").collect()
    assert sorted((str(r.doc_id), r.n, str(r.component_id)) for r in got) == sorted([
        ("None", 2, "3"), ("None", 1, "None"), ("3", 2, "3"), ("3", 2, "3"), ("3", 1, "3"), ("4", 1, "4")])


def test_components_of_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(60)] + [(k, k + 1) for k in range(1000, 1100)]
    group = {x: x for link in links for x in link}
    for _ in range(200):
        for x, y in links:
            group[x] = group[y] = min(group[x], group[y])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {x: g for x, g in group.items() if any(x in link and link[0] != link[1] for link in links)}
