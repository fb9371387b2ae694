import pytest
from pyspark.sql import functions as F

from zonewright.operators.merge import DuplicateKeys, MissingColumns
from zonewright.session import Staging
from zonewright.sources.files import Files
from zonewright.sources.store import TableNotFound, TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "zone"))


def people(spark, data):
    return spark.createDataFrame(data, "id int, name string")


def test_missing_table(store, spark):
    assert not store.exists("a/b")
    with pytest.raises(TableNotFound):
        store.read("a/b")
    assert store.upsert("a/b", people(spark, []), ["id"]) == 0
    assert not store.exists("a/b")
    assert store.drop("a/b") is False


def test_upsert_creates_then_merges(store, spark, rows):
    assert store.upsert("a/b", people(spark, [(1, "x"), (2, "y")]), ["id"]) == 2
    assert store.upsert("a/b", people(spark, [(2, "Y"), (3, "z")]), ["id"]) == 2
    assert rows(store.read("a/b")) == [(1, "x"), (2, "Y"), (3, "z")]


def test_upsert_twice_is_once(store, spark, rows):
    change = people(spark, [(1, "x"), (2, "y")])
    store.upsert("t", change, ["id"])
    store.upsert("t", change, ["id"])
    assert rows(store.read("t")) == rows(change)


def test_empty_upsert_changes_nothing(store, spark, rows):
    store.upsert("t", people(spark, [(1, "x")]), ["id"])
    before = store._version("t")
    assert store.upsert("t", people(spark, []), ["id"]) == 0
    assert store._version("t") == before


def test_duplicate_keys_fail_and_leave_the_table(store, spark, rows):
    store.upsert("t", people(spark, [(1, "x")]), ["id"])
    with pytest.raises(DuplicateKeys):
        store.upsert("t", people(spark, [(1, "a"), (1, "b")]), ["id"])
    with pytest.raises(DuplicateKeys):
        store.upsert("new", people(spark, [(7, "a"), (7, "b")]), ["id"])
    assert rows(store.read("t")) == [(1, "x")] and not store.exists("new")


def test_null_keys_are_inserted_every_time(store, spark, rows):
    change = people(spark, [(None, "n"), (1, "x")])
    for _ in range(5):
        store.upsert("t", change, ["id"])
    assert rows(store.read("t")) == [(1, "x")] + [(None, "n")] * 5


def test_many_upserts_keep_the_latest(store, spark, rows):
    store.upsert("t", people(spark, [(i, "0") for i in range(6)]), ["id"])
    for step in range(1, 6):
        store.upsert("t", people(spark, [(step, str(step)), (0, str(step))]), ["id"])
        expected = [(0, str(step))] + [(i, str(i) if i <= step else "0") for i in range(1, 6)]
        assert rows(store.read("t")) == expected
    version = store._version("t")  # nothing is left but this version and the one before
    named = {path.split("/")[0] for path in [*version.sets(), *version.before]}
    assert set(Files(spark).names(f"{store.root}/t/data")) == named


def test_an_upsert_touches_only_changed_buckets(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "zone"), buckets=16)
    store.create("t", spark.range(4000).selectExpr("cast(id AS int) AS id", "'old' AS name"), keys=["id"])
    before = store._version("t").data
    assert len(before) == 16 and all(len(sets) == 1 for sets in before.values())
    assert store.upsert("t", people(spark, [(5, "new"), (5000, "more")]), ["id"]) == 2
    after = store._version("t").data
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and after.keys() == before.keys()
    assert store.read("t").count() == 4001
    assert rows(store.read("t").filter("name <> 'old'")) == [(5, "new"), (5000, "more")]
    # What is written follows the changes: the rows of the changed buckets, and no others.
    written = store._rows("t", store._version("t"), changed).count()
    assert written < 4001 * 3 // 16
    store.upsert("t", people(spark, [(5, "newer")]), ["id"])
    last = store._version("t").data
    assert len([b for b in last if last[b] != after[b]]) == 1


def test_a_table_that_grows_gets_more_buckets(store, spark, rows, monkeypatch):
    monkeypatch.setattr("zonewright.sources.store.BUCKET_BYTES", 2000)
    store.upsert("t", people(spark, [(i, "a") for i in range(5)] + [(None, "n")]), ["id"])
    assert store._version("t").buckets == 1
    store.upsert("t", spark.range(9000).selectExpr("cast(id AS int) AS id", "uuid() AS name"), ["id"])
    grown = store._version("t")
    assert grown.buckets >= 32 and set(grown.data) == {str(b) for b in range(-1, grown.buckets)}
    assert store.read("t").count() == 9001
    store.upsert("t", people(spark, [(7, "changed")]), ["id"])
    after = store._version("t")
    assert len([b for b in after.data if after.data[b] != grown.data[b]]) == 1
    assert rows(store.read("t").filter("name = 'changed' OR id IS NULL")) == [(7, "changed"), (None, "n")]
    named = {path.split("/")[0] for path in [*after.sets(), *after.before]}
    assert set(Files(spark).names(f"{store.root}/t/data")) == named


def test_a_new_table_is_written_once_and_dealt_by_its_first_merge(store, spark, rows, monkeypatch):
    monkeypatch.setattr("zonewright.sources.store.BUCKET_BYTES", 2000)
    made = spark.range(9000).selectExpr("cast(if(id < 8999, id, NULL) AS int) AS id", "uuid() AS name")
    store.upsert("t", made, ["id"])
    new = store._version("t")
    assert len(Files(spark).names(f"{store.root}/t/data")) == 1 and new.buckets == 1
    assert store.upsert("t", people(spark, [(7, "changed"), (9999, "more"), (None, "n")]), ["id"]) == 3
    dealt = store._version("t")
    assert dealt.buckets >= 32 and set(dealt.data) == {str(b) for b in range(-1, dealt.buckets)}
    assert set(dealt.bytes) == set(dealt.data) and all(n > 0 for n in dealt.bytes.values())
    assert store.read("t").count() == 9002 and store.read("t").select("id").distinct().count() == 9001
    assert rows(store.read("t").filter("length(name) < 20")) == [(7, "changed"), (9999, "more"), (None, "n")]
    named = {path.split("/")[0] for path in [*dealt.sets(), *dealt.before]}
    assert set(Files(spark).names(f"{store.root}/t/data")) == named
    store.upsert("t", people(spark, [(7, "again")]), ["id"])
    assert len([b for b, sets in store._version("t").data.items() if sets != dealt.data[b]]) == 1


def test_appended_rows_deal_a_table_that_has_outgrown_its_buckets(store, spark, monkeypatch):
    monkeypatch.setattr("zonewright.sources.store.BUCKET_BYTES", 2000)
    store.create("t", people(spark, [(1, "a"), (None, "n")]), keys=["id"])
    store.create("t", spark.range(10, 9000).selectExpr("cast(id AS int) AS id", "uuid() AS name"), mode="append")
    assert store._version("t").buckets >= 32 and store.read("t").count() == 8992


def test_rows_of_one_bucket_are_not_sorted_for_it(store, spark, rows, tmp_path):
    df = spark.range(100).selectExpr("cast(if(id % 10 = 0, NULL, id) AS int) AS id", "'a' AS name").coalesce(1)
    store.upsert("t", df, ["id"])
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    assert rows(store.read("t").groupBy(F.col("id").isNull()).count()) == [(False, 90), (True, 10)]
    assert set(store._version("t").data) == {"0", "-1"}


def test_rows_without_a_key_are_never_merged(store, spark, rows, monkeypatch):
    monkeypatch.setattr("zonewright.sources.store.LOOSE_SETS", 3)
    for n in range(5):
        store.upsert("t", people(spark, [(None, f"n{n}"), (1, f"x{n}")]), ["id"])
    assert rows(store.read("t")) == [(1, "x4")] + [(None, f"n{n}") for n in range(5)]
    assert len(store._version("t").data["-1"]) <= 3


def test_appended_rows_are_checked_and_merged_later(store, spark, rows):
    store.create("t", people(spark, [(i, "a") for i in range(50)]), keys=["id"])
    store.create("t", people(spark, [(i, "b") for i in range(50, 60)]), mode="append")
    with pytest.raises(DuplicateKeys):
        store.create("t", people(spark, [(49, "again")]), mode="append")
    store.upsert("t", people(spark, [(55, "c"), (3, "c")]), ["id"])
    assert sorted(rows(store.read("t"))) == [(i, "c" if i in (3, 55) else "a" if i < 50 else "b") for i in range(60)]


def test_a_table_without_rows(store, spark, rows):
    store.create("t", people(spark, []), keys=["id"])
    assert store.exists("t") and rows(store.read("t")) == [] and store.read("t").columns == ["id", "name"]
    store.upsert("t", people(spark, [(1, "x")]), ["id"])
    assert rows(store.read("t")) == [(1, "x")]


def test_a_read_is_a_plain_scan(store, spark, final_plan):
    store.upsert("t", people(spark, [(1, "x"), (2, "y")]), ["id"])
    store.upsert("t", people(spark, [(2, "z")]), ["id"])
    plan = final_plan(store.read("t"))
    assert "Join" not in plan and "Exchange" not in plan


def test_create_and_append_check_keys(store, spark, rows):
    with pytest.raises(DuplicateKeys):
        store.create("t", people(spark, [(1, "a"), (1, "b")]), keys=["id"])
    assert not store.exists("t")
    store.create("t", people(spark, [(1, "a"), (None, "n"), (None, "n")]), keys=["id"])
    with pytest.raises(DuplicateKeys):
        store.create("t", people(spark, [(1, "again")]), mode="append")
    store.create("t", people(spark, [(2, "b")]), mode="append")
    assert rows(store.read("t")) == [(1, "a"), (2, "b"), (None, "n"), (None, "n")]


def test_column_rules(store, spark, rows):
    store.upsert("t", people(spark, [(1, "x")]), ["id"])
    wider = spark.createDataFrame([("q", 2, 5)], "name string, id int, extra int")
    store.upsert("t", wider, ["id"])
    assert rows(store.read("t")) == [(1, "x"), (2, "q")]
    with pytest.raises(MissingColumns):
        store.upsert("t", people(spark, [(1, "x")]).select("id"), ["id"])
    with pytest.raises(ValueError):
        store.upsert("t", people(spark, [(1, "x")]), ["name"])


def test_repeated_writer_number_is_a_no_op(store, spark, rows):
    change = people(spark, [(None, "n")])
    assert store.upsert("t", change, ["id"], writer=("s", 4)) == 1
    assert store.upsert("t", change, ["id"], writer=("s", 4)) == 0
    assert store.upsert("t", change, ["id"], writer=("s", 3)) == 0
    assert store.upsert("t", change, ["id"], writer=("other", 0)) == 1
    assert rows(store.read("t")) == [(None, "n")] * 2


def test_create_modes(store, spark, rows):
    store.create("t", people(spark, [(1, "x")]), keys=["id"])
    store.create("t", people(spark, [(9, "x")]), keys=["id"], mode="ignore")
    with pytest.raises(FileExistsError):
        store.create("t", people(spark, [(9, "x")]), keys=["id"], mode="error")
    store.upsert("t", people(spark, [(1, "y")]), ["id"])
    store.create("t", people(spark, [(2, "z")]), mode="append")
    assert rows(store.read("t")) == [(1, "y"), (2, "z")]
    store.create("t", store.read("t").filter("id = 2"), keys=["id"])  # reads what it replaces
    assert rows(store.read("t")) == [(2, "z")]


def test_readers_keep_their_snapshot(store, spark, rows):
    store.create("t", people(spark, [(1, "x")]), keys=["id"])
    old = store.read("t")
    store.upsert("t", people(spark, [(1, "y")]), ["id"])
    assert rows(old) == [(1, "x")] and rows(store.read("t")) == [(1, "y")]


def test_unfinished_write_is_invisible(store, spark, rows):
    store.create("t", people(spark, [(1, "x")]), keys=["id"])
    store._write("t", people(spark, [(2, "lost")]), store._version("t"))
    assert rows(store.read("t")) == [(1, "x")]


def test_the_pointer_is_replaced_whole(spark, tmp_path):
    files, path = Files(spark), str(tmp_path / "p")
    for text in ("one", "two"):
        files.replace_text(path, text)
        assert files.read_text(path) == text
    assert files.names(str(tmp_path)) == ["p"] or files.names(str(tmp_path)) == [".p.crc", "p"]


def test_partitioned_table(store, spark, rows, final_plan):
    data = spark.range(20).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 4).cast("int").alias("part")
    )
    store.create("t", data, keys=["id"], partition_by=["part"])
    store.upsert("t", spark.createDataFrame([(1, 3)], "id int, part int"), ["id"])
    assert store.read("t").columns == ["id", "part"]
    assert rows(store.read("t").filter("id < 3")) == [(0, 0), (1, 3), (2, 2)]
    assert "PartitionFilters: [isnotnull(part" in final_plan(store.read("t").filter("part = 2"))


def test_types_survive(store, spark, rows):
    df = spark.sql(
        "SELECT 1 AS id, TIMESTAMP '2024-01-01 10:00:00' AS t, "
        "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS n, array(struct(1 AS a)) AS l, 1.5D AS d"
    )
    store.upsert("t", df, ["id"])
    assert store.read("t").dtypes == df.dtypes
    assert rows(store.read("t")) == rows(df)


def test_show_names_and_drop(store, spark, capsys):
    store.create("t", people(spark, [(1, "x"), (2, "y")]), keys=["id"])
    assert store.show("t") == 2
    assert "|  1|   x|" in capsys.readouterr().out
    assert store.names() == ["t"]
    assert store.drop("t") is True and not store.exists("t")


def test_files_are_packed_and_hold_a_bounded_number_of_rows(store, spark, tmp_path, monkeypatch):
    """However well rows are packed, a task that reads whole files gets few enough to sort."""
    monkeypatch.setattr("zonewright.session.FILE_ROWS", 100)
    rows = spark.range(1000).selectExpr("cast(id AS int) AS id", "'same' AS name").coalesce(1)
    store.create("keyed", rows, keys=["id"])
    store.create("plain", rows)
    staged = Staging(spark, "bounded")
    held = staged.put(rows)
    try:
        for found in (store.read("keyed"), store.read("plain"), held):
            sizes = found.groupBy(F.input_file_name().alias("file")).count().collect()
            assert len(sizes) == 10 and {r["count"] for r in sizes} == {100}
            assert all(".zstd." in r["file"] for r in sizes)
    finally:
        staged.clear()


def test_packed_rows_are_not_broadcast_for_their_file_size(store, spark):
    """A few packed bytes a row are not what a join's side takes on the driver."""
    rows = spark.range(200_000).selectExpr("id", "'same' AS name", "array_repeat(1.0f, 64) AS embedding")
    store.create("t", rows, keys=["id"])
    found = store.read("t")
    packed = Files(spark).size(f"{store.root}/t/data")
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 10 * packed
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * packed))
    try:
        plan = found.join(found.select("id", F.col("embedding").alias("other")), "id")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "BroadcastHashJoin" not in plan
