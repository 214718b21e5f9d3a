"""Each query against its SQL, and the registry."""
import duckdb
import pytest

from wxodds.llm.registry import ORACLE, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_over_the_whole_table(spark, name):
    table = "pages" if name.startswith("op2_") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    ids = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key)
    assert QUERIES[name](spark, SF_SMALL).select(key).distinct().count() == ids.distinct().count()


def test_each_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
