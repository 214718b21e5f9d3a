import pytest

pytest.importorskip("wxodds.llm")


@pytest.fixture(autouse=True)
def _prepared(spark):
    from wxodds.llm.storage import prepare
    prepare(spark)


@pytest.fixture()
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with further columns whose names operators use inside."""
    def make(rows):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, "x") for i, t in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long, "
                                   "node long, text_key long, gone string")
        return df.repartition(3)
    return make
