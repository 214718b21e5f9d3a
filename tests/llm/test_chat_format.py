"""Folding of events, the template's round trip and the mask, against plain Python."""
import hashlib
import random

from pyspark.sql import functions as F

from wxodds.llm import chat_format as C

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def fold(events):
    out = {}
    for conv, message, _, kind, role, text in sorted(
            events, key=lambda e: (e[0] is None, e[0] or 0, e[1], e[2], e[3] == "delta", e[5] or "")):
        r, t = out.get((conv, message), ("", ""))
        r = role if role is not None else r
        t = {"message": text or "", "edit": text or "", "regenerate": "", "delta": t + (text or "")}[kind]
        out[conv, message] = (r, t)
    return out


def test_fold_of_random_events(spark):
    rng = random.Random(2)
    events = [(c, m, s, "message" if s == 0 else rng.choice(["delta", "delta", "edit", "regenerate"]),
               "user" if s == 0 else None, rng.choice(["a", "<|im_end|>", "", None, "é\n"]))
              for c in (1, 2, None) for m in range(4) for s in range(rng.randint(1, 9))]
    got = C.reconstruct(spark.createDataFrame(events, EVENTS)).collect()
    assert {(r.conv_id, r.message): (r.role, r.text) for r in got} == fold(events)


def test_deltas_without_a_start_and_ties(spark):
    events = [(1, 0, 5, "delta", None, "b"), (1, 0, 5, "delta", None, "a"), (1, 0, 5, "edit", "user", "x")]
    (row,) = C.reconstruct(spark.createDataFrame(events, EVENTS)).collect()
    assert (row.role, row.text) == ("user", "xab")
    assert C.reconstruct(spark.createDataFrame([], EVENTS)).count() == 0


def test_round_trip_and_mask(spark):
    nasty = ["<|im_start|>", "<|im_end|>", "\\", "\\l", "\\b<|", "<", "|", "\n", "\\n", "é😀", "", "a"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", "<|im_end|>", None]), "".join(rng.choices(nasty, k=rng.randint(0, 6))) or None)
            for c in range(30) for t in range(rng.randint(1, 5))] + [(99, 0, "assistant", "x"), (99, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("message", F.lit(1))
    out = C.render(C.reconstruct(C.events_of(df)))
    got = out.select("conv_id", C.parse(F.col("formatted")).alias("turns"), "formatted",
                     C.masked(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in got:
        want = sorted((t, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(ro, x) for _, ro, x in want]
        assert r.loss == "".join(x for _, ro, x in want if ro == "assistant")
        assert r.formatted.count("<|im_start|>") == len(want)


def test_query_planted_conversation(spark, tmp_path):
    from wxodds.llm.queries_chat import PLANTED, op10_chat_format
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    (row,) = op10_chat_format(spark, str(tmp_path)).collect()
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, len(PLANTED))
    assert row.loss_sha256 == hashlib.sha256(PLANTED.encode()).hexdigest()
