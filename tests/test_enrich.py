import pytest
from pyspark.sql import functions as F

from zonewright.operators.enrich import dictionary_lookup, lookup_join, override_join
from zonewright.operators.export import export_rows
from zonewright.operators.merge import merge_frames


def left(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (5, "e")], "k int, l string")


def right(spark):
    return spark.createDataFrame([(1, "x"), (2, "z"), (2, "y"), (None, "n")], "k int, r string")


def test_lookup_never_multiplies_or_loses_left_rows(spark, rows):
    got = lookup_join(left(spark), right(spark), ["k"])
    assert rows(got) == sorted(
        [(1, "a", "x"), (2, "b", "y"), (2, "c", "y"), (None, "d", None), (5, "e", None)], key=repr
    )
    inner = lookup_join(left(spark), right(spark), ["k"], "inner", right_order=[F.desc("r")])
    assert rows(inner) == [(1, "a", "x"), (2, "b", "z"), (2, "c", "z")]


def test_override_lets_a_matched_null_win(spark, rows):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    detail = spark.createDataFrame([(1, None, True)], "k int, v string, extra boolean")
    assert rows(override_join(base, detail, ["k"])) == [(1, None, 1, True), (2, "b", 2, None)]


def test_dictionary_lookup(spark, rows):
    df = spark.createDataFrame(
        [(1, [3, 1, 1, 9]), (2, []), (3, None), (4, [2])], "k int, ids array<int>"
    )
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, name string")
    got = dictionary_lookup(df, "ids", names, "id", "name", "names", row_key=["k"])
    assert rows(got.select("k", "names")) == [
        (1, ["one", "three"]),
        (2, []),
        (3, []),
        (4, ["two"]),
    ]


def test_dictionary_lookup_keeps_rows_apart(spark, rows):
    names = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    df = spark.createDataFrame([(1, [1]), (2, [2]), (None, [3])], "k int, ids array<int>")
    got = dictionary_lookup(df, "ids", names, "id", "name", "names", row_key=["k"])
    assert rows(got.select("k", "names")) == [(1, ["a"]), (2, ["b"]), (None, ["c"])]
    twice = df.union(df.filter("k = 1"))
    with pytest.raises(Exception, match="row key repeats"):
        dictionary_lookup(twice, "ids", names, "id", "name", "names", row_key=["k"]).collect()


def test_dictionary_lookup_with_an_empty_dictionary(spark):
    df = spark.createDataFrame([(1, [3])], "k int, ids array<int>")
    names = spark.createDataFrame([], "id int, name string")
    got = dictionary_lookup(df, "ids", names, "id", "name", "names", row_key=["k"])
    assert got.first()["names"] == []


SPLIT_SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture
def split_small(spark):
    saved = {k: spark.conf.get(k, None) for k in SPLIT_SMALL}
    for key, value in SPLIT_SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_key_is_split_over_tasks(spark, split_small, tmp_path, final_plan):
    hot = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    hot.write.parquet(str(tmp_path / "hot"))
    lookup = spark.range(0, 60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = lookup_join(
        spark.read.parquet(str(tmp_path / "hot")), lookup.union(lookup), ["k"]
    ).select("k", "payload", "v")
    assert "skew=true" in final_plan(joined)
    totals = joined.agg(F.count(F.lit(1)), F.sum("v")).first()
    expected = hot.agg(F.count(F.lit(1)), F.sum(F.col("k") * 2)).first()
    assert tuple(totals) == tuple(expected)


def test_merge_splits_a_target_full_of_null_keys(spark, split_small, tmp_path, final_plan):
    target = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    target.write.parquet(str(tmp_path / "target"))
    source = spark.range(50_000, 70_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    source.write.parquet(str(tmp_path / "source"))
    merged = merge_frames(
        spark.read.parquet(str(tmp_path / "target")),
        spark.read.parquet(str(tmp_path / "source")),
        ["k"],
    )
    assert "skew=true" in final_plan(merged)
    counts = merged.agg(F.count(F.lit(1)), F.count("k"), F.count_if(F.col("v") == "new")).first()
    assert tuple(counts) == (20_000 + 33_333 + 20_000, 53_333, 20_000)


def test_unique_sides_share_one_shuffle(spark, split_small, final_plan):
    a = spark.range(1000).select(F.col("id").alias("k")).distinct()
    b = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = final_plan(lookup_join(a, b, ["k"], left_unique=True))
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2


def test_export_rows(spark, rows):
    df = spark.sql(
        "SELECT 1 AS i, TIMESTAMP '2024-01-02 03:04:05' AS t, TIMESTAMP_NTZ '2024-01-02 03:04:05.5'"
        " AS n, double('NaN') AS d, float(1.5) AS f, named_struct('a', 1) AS s"
        " UNION ALL SELECT NULL, NULL, NULL, NULL, float('NaN'), NULL"
    )
    got = export_rows(df)
    assert [t for _, t in got.dtypes] == ["int", "string", "string", "double", "float", "struct<a:int>"]
    first, second = sorted(got.collect(), key=lambda r: r["i"] is None)
    assert tuple(first)[:5] == (1, "2024-01-02 03:04:05", "2024-01-02 03:04:05.5", None, 1.5)
    assert tuple(second) == (None,) * 6
    fixed = export_rows(df, ["t", "i"], "yyyy-MM-dd'T'HH:mm")
    assert fixed.columns == ["t", "i"] and ("2024-01-02T03:04", 1) in rows(fixed)
