"""Removed sentences against runs of every length, and edge rows."""
import random
import re
from collections import defaultdict

from wxodds.llm import sentence_dedup as S


def brute(rows):
    """The method without its shortcut: runs of every length are hashed over all rows, the first place of each
    run is the least (doc_id, last sentence), and every other place covers its sentences."""
    parts, places = {}, defaultdict(list)
    for i, t in rows:
        ends = [m.end() for m in re.finditer(r"[.!?]+\s+|\s*\n\s*", t or "")]
        cut = [(a, b) for a, b in zip([0, *ends], [*ends, len(t or "")], strict=True) if a < b]
        w = [tuple(t[a:b].lower().split()) for a, b in cut]
        parts[i] = t, cut, set()
        for a in range(len(w)):
            n = 0
            for b in range(a, len(w)):
                n += len(w[b])
                if w[a] and w[b] and n >= (S.LONE_WORDS if a == b else S.SPAN_WORDS):
                    places[tuple(w[a:b + 1])].append((i, b, a))
    for found in places.values():
        for i, b, a in sorted(found)[1:]:
            parts[i][2].update(range(a, b + 1))
    return [(i, "".join(t[a:b] for j, (a, b) in enumerate(cut) if j not in gone) if t else t, len(cut), len(gone))
            for i, (t, cut, gone) in sorted(parts.items())]


def rows(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(f"w{rng.randint(0, 300)}" for _ in range(n)).capitalize() + rng.choice([". ", "! ", "\n", ".\n\n"])
    passages = ["".join(say(rng.randint(3, 30)) for _ in range(rng.randint(1, 6))) for _ in range(8)]
    out = [(0, None), (1, ""), (2, "\n\n"), (3, "One."), (4, "x " * 5000), (5, "Same same. " * 50)]
    for i in range(6, 120):
        out.append((i, "".join(rng.choice([say(rng.randint(1, 20)), rng.choice(passages)]) for _ in range(rng.randint(0, 6)))))
    return out


def test_against_brute_force(spark, docs_of):
    for seed in (1, 2):
        got = [(r.doc_id, r.text, r.n_sentences, r.n_removed) for r in S.dedup(docs_of(rows(seed))).collect()]
        assert sorted(got) == brute(rows(seed))


def test_a_long_passage_is_caught_whatever_its_sentences(spark, docs_of):
    words = [f"p{k}" for k in range(60)]
    for cuts in ([], [30], [10, 20, 30, 40, 50], [11], [49]):
        passage = " ".join(w + ("." if k + 1 in cuts else "") for k, w in enumerate(words)) + "."
        out = {r.doc_id: r for r in S.dedup(docs_of([(1, f"Clean start here. {passage}"), (2, f"Another one begins.\n{passage}\nAnd ends.")])).collect()}
        assert out[1].n_removed == 0 and "p5" not in out[2].text and "And ends." in out[2].text


def test_edges(spark, docs_of):
    long = "a b c d e f g. h i j k l m n o. "
    out = S.dedup(docs_of([(None, long), (1, long), (2, long), (2, long)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in out) == [("1", 2), ("2", 2), ("2", 2), ("None", 0)]
    assert all(r.gone == "x" and r.text_key == 2 for r in out)      # other columns stay
    assert S.dedup(docs_of([])).count() == 0


def test_runs_that_overlap_their_own_copies(spark, docs_of):
    r = random.Random(5)
    for trial in range(3):
        say = [" ".join(f"q{k}z{j}" for j in range(r.randrange(16))) + ". " for k in range(4)]
        repeats = [(k, "".join(r.choice(say) for _ in range(r.randrange(14)))) for k in range(40)]
        got = [(x.doc_id, x.text, x.n_sentences, x.n_removed) for x in S.dedup(docs_of(repeats)).collect()]
        assert sorted(got) == brute(repeats)


def test_a_passage_goes_with_its_short_head(spark, docs_of):
    for lengths in ((3, 9, 48), (3, 2, 3, 4, 20, 30), (1, 1, 13), (7, 3, 7), (20, 1, 1)):
        passage = " ".join(" ".join(f"p{j}x{k}" for k in range(n)) + "." for j, n in enumerate(lengths))
        out = {r.doc_id: r for r in S.dedup(docs_of([(1, f"Clean start here. {passage} Then an end."),
                                                     (2, f"Another one begins. {passage} And more.")])).collect()}
        assert out[1].n_removed == 0 and out[2].n_removed == len(lengths)
        assert out[2].text == "Another one begins. And more."
