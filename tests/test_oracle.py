"""Every registered query against its SQL in DuckDB, over the whole small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from zonewright.catalog import REGISTRY

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 9)
        return value

    return [names[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr
    )


# Queries that end in one row per metric or table, and so in one last task.
GLOBAL_COUNTS = {"quality_counts", "landing_tables", "trusted_tables", "serving_tables"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) & set(entry_points.oracle_sql())))
def test_query_matches_its_sql(spark, database, name):
    df = entry_points.queries()[name](spark, FOLDER)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for never in ("CartesianProduct", "NestedLoop", "BatchEvalPython"):
        assert never not in plan
    assert name in GLOBAL_COUNTS or "SinglePartition" not in plan
    cursor = database.execute(entry_points.oracle_sql()[name])
    want = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_queries_without_sql_are_the_known_ones():
    assert set(REGISTRY) <= set(entry_points.oracle_sql())


def test_entry_has_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema and not first.isEmpty()
