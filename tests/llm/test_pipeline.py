"""Every stage on its own input, edge rows, and the whole run."""
import corpus_pipeline as C
import pytest

from wxodds.llm import decontamination, ngram_join, pii

SF_SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def odd(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, None), (2, ""), (None, long), (None, long + " x"), (None, "quite other words in here again"), (5, long), (5, long),
            (6, "a@b.co"), (7, "x " * 30_000), (8, "four words stand here"), (8, "an other text of one id")]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)


def test_near_copies(spark, odd):
    got = [(r.doc_id, r.text) for r in C.drop_near_copies(spark, odd, SF_SMALL).collect()]
    ids = sorted((i for i, _ in got if i is not None))
    assert ids == [1, 2, 5, 6, 7, 8, 8] and sum(i is None for i, _ in got) == 1


def test_stages_take_odd_rows_and_keep_columns(spark, odd):
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, odd, SF_SMALL)
        assert out.columns == odd.columns, name
        assert stage(spark, odd.limit(0), SF_SMALL).count() == 0
        if name in ("toxicity", "decontamination", "pii"):
            assert out.count() == odd.count(), name
    assert C.pack(spark, odd, SF_SMALL).select("doc_id").distinct().count() == 7


def test_run(spark):
    from wxodds.llm.storage import load, written
    docs = load(spark, SF_SMALL, "documents")
    for name, stage in C.STAGES:
        before, docs = docs, written(stage(spark, docs, SF_SMALL), name)
        if name == "ngram_join":
            parts = ngram_join.components(before).where("n > 0")
            assert docs.where("trim(text) <> ''").count() == parts.select("part").distinct().count()
        if name == "decontamination":
            judged = decontamination.decontaminate(before, load(spark, SF_SMALL, "benchmark"))
            assert docs.count() == judged.where("not contaminated").count()
        if name == "pii":
            assert all(not [s for s in pii.spans(r.text) if s[0] in pii.BASE] for r in docs.collect())
            assert docs.where("n_chars <> length(text)").count() == 0
            kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in docs.select("doc_id").collect()} == kept
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_a_stage_drops_the_tables_of_those_before_it(spark, odd):
    import os
    near = dict(C.STAGES)["ngram_join"](spark, odd, SF_SMALL)
    had = list(C._LEFT[1])
    assert any(os.path.isdir(p.removeprefix("file://")) for p in had)     # the stage has removed some itself
    rows = near.collect()
    kept = spark.createDataFrame(rows, DOC)
    out = dict(C.STAGES)["decontamination"](spark, kept, SF_SMALL)
    assert not C._LEFT[1] and not any(os.path.isdir(p.removeprefix("file://")) for p in had)
    assert out.count() <= len(rows)
