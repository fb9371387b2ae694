import json
import sqlite3
import uuid

import pytest
from pyspark.sql import functions as F

from zonewright.sources.sinks import batches, conflict_upsert, handed_over, index_upsert, relational_upsert


def test_batches():
    assert list(batches(range(5), 2)) == [[0, 1], [2, 3], [4]]
    assert list(batches([], 2)) == []


def test_conflict_upsert():
    assert conflict_upsert("t", ["a", "b", "c"], ["a"]) == (
        "INSERT INTO t (a, b, c) VALUES (?, ?, ?) "
        "ON CONFLICT (a) DO UPDATE SET b = excluded.b, c = excluded.c"
    )
    assert conflict_upsert("t", ["a"], ["a"], "%s").endswith("ON CONFLICT (a) DO NOTHING")


def recorder(folder):
    """A DB-API like connection that notes what it was asked to do."""

    class Connection:
        def cursor(self):
            return self

        def executemany(self, statement, rows):
            self.pending = {"statement": statement, "rows": rows}

        def commit(self):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                json.dump(self.pending, out)

        def close(self):
            pass

    return Connection


def test_relational_upsert(spark, tmp_path):
    df = spark.range(0, 250, 1, 5).select("id", F.lit("x").alias("name"))
    folder = str(tmp_path)
    relational_upsert(df, recorder(folder), "t", ["id"], batch_rows=30, connections=2)
    calls = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(r[0] for c in calls for r in c["rows"]) == list(range(250))
    assert all(len(c["rows"]) <= 30 for c in calls)
    assert {c["statement"] for c in calls} == {conflict_upsert("t", ["id", "name"], ["id"])}


def test_index_upsert(spark, tmp_path):
    df = spark.range(0, 230, 1, 2).select(
        F.col("id").cast("string").alias("id"),
        F.array(F.lit(1.0), F.lit(0.5)).alias("embedding"),
        F.struct(F.lit("m").alias("title")).alias("metadata"),
    )
    folder = str(tmp_path)

    class Index:
        def upsert(self, items):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                json.dump(items, out)

    index_upsert(df, Index)
    calls = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    items = [i for c in calls for i in c]
    assert sorted(int(i[0]) for i in items) == list(range(230))
    assert max(map(len, calls)) == 100
    assert items[0][1:] == [[1.0, 0.5], {"title": "m"}]


@pytest.fixture
def database(tmp_path):
    """A file that tasks of one machine open as a database; opened by name, so that tasks can."""
    path = str(tmp_path / "db")
    own = sqlite3.connect(path)
    own.execute("CREATE TABLE people (id INTEGER PRIMARY KEY, name TEXT, age INTEGER)")
    own.execute("INSERT INTO people VALUES (1, 'old', 1), (1000, 'other', 2)")
    own.commit()
    yield path, own
    own.close()


def test_handed_over_in_two_steps(spark, database):
    path, own = database
    df = spark.range(0, 250, 1, 5).select("id", F.lit("x").alias("name"), F.when(F.col("id") > 5, F.col("id")).alias("age"))
    for _ in range(2):
        assert handed_over(df, lambda: sqlite3.connect(path, timeout=60), "people", ["id"], batch_rows=30, connections=3) == 250
    assert own.execute("SELECT count(*), sum(name = 'x'), sum(age IS NULL) FROM people").fetchone() == (251, 250, 6)
    assert own.execute("SELECT name FROM people WHERE id = 1000").fetchone() == ("other",)
    assert own.execute("SELECT count(*) FROM sqlite_master").fetchone() == (1,)  # nothing staged is left


def test_a_task_that_fails_midway_leaves_the_target(spark, database):
    path, own = database

    class Breaks:
        """Fails after some batches have been committed."""

        def __init__(self):
            self.inner, self.left = sqlite3.connect(path, timeout=60), 3

        def cursor(self):
            if self.left == 0:
                raise RuntimeError("lost")
            return self.inner.cursor()

        def commit(self):
            self.left -= 1
            self.inner.commit()

        def close(self):
            self.inner.close()

    df = spark.range(0, 250, 1, 2).select("id", F.lit("x").alias("name"), F.lit(7).alias("age"))
    with pytest.raises(Exception, match="lost"):
        handed_over(df, Breaks, "people", ["id"], batch_rows=20)
    assert own.execute("SELECT id, name, age FROM people ORDER BY id").fetchall() == [(1, "old", 1), (1000, "other", 2)]
    assert own.execute("SELECT count(*) FROM sqlite_master").fetchone() == (1,)
    assert handed_over(df, lambda: sqlite3.connect(path, timeout=60), "people", ["id"]) == 250
    assert own.execute("SELECT count(*) FROM people").fetchone() == (251,)


def test_rows_of_a_lost_attempt_are_not_seen(spark, database):
    path, own = database

    def connect():
        # An attempt nobody knows of writes to the staging table before the tasks do.
        connection = sqlite3.connect(path, timeout=60)
        for (name,) in connection.execute("SELECT name FROM sqlite_master WHERE name LIKE 'people_staged_%' AND name NOT LIKE '%_won'").fetchall():
            connection.execute(f"INSERT INTO {name} VALUES (0, -1, 77, 'lost', 0)")
        return connection

    df = spark.range(0, 10, 1, 2).select("id", F.lit("x").alias("name"), F.lit(7).alias("age"))
    assert handed_over(df, connect, "people", ["id"]) == 10
    assert own.execute("SELECT count(*) FROM people WHERE name = 'lost'").fetchone() == (0,)
