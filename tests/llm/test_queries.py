"""The registered queries: against SQL where there is some, and over their whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
LLM = sorted(set(entry_points.LLM_QUERIES) & set(entry_points.LLM_ORACLES))


@pytest.mark.parametrize("name", LLM)
def test_query_matches_its_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = database.execute(entry_points.oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    want = sorted((tuple(dict(zip([c[0] for c in cursor.description], r, strict=True))[c] for c in columns) for r in cursor.fetchall()), key=repr)
    df = entry_points.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


def test_all_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name, table", [("op1_main_text", "pages"), ("op3_sharding", "documents"), ("op4_toxicity", "documents"), ("op7_pii", "documents"), ("op9_neardup", "documents"), ("op11_lines", "documents")])
def test_one_row_for_each_of_the_table(spark, name, table):
    key = "page_id" if table == "pages" else "doc_id"
    given = [r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()]
    got = [r[0] for r in entry_points.queries()[name](spark, FOLDER).select(key).collect()]
    assert sorted(got) == sorted(given)
