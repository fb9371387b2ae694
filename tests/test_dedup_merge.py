import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from zonewright.operators.dedup import distinct_rows, keep_first, keep_one, keep_one_present
from zonewright.operators.merge import (
    DuplicateKeys,
    MissingColumns,
    merge_frames,
    require_unique,
)


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string, n int")


def test_keep_one_is_deterministic_on_ties(spark, rows):
    data = [(1, "b", 5), (1, "a", 5), (1, "c", 4), (2, "x", 1), (2, "x", 1), (None, "z", 1)]
    for order in (data, data[::-1]):
        df = frame(spark, order).repartition(3)
        assert rows(keep_one(df, ["k"], [F.desc("n")])) == [
            (1, "a", 5),
            (2, "x", 1),
            (None, "z", 1),
        ]


def test_keep_one_trims_hot_keys_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("n"),
    )
    got = keep_one(df, ["k"], [F.desc("n")])
    assert got.count() == 20_001
    plan = got._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_keep_one_with_maps(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    assert keep_one(df, ["k"]).count() == 1


def test_keep_first(spark, rows):
    df = frame(spark, [(1, str(i), i) for i in range(10)] + [(2, "x", 0)])
    got = keep_first(df, ["k"], [F.asc("n")], 3)
    assert rows(got.select("k", "n")) == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_keep_one_present_keeps_null_keys(spark, rows):
    df = frame(spark, [(None, "a", 1), (None, "a", 1), (1, "b", 1), (1, "c", 2)])
    assert rows(keep_one_present(df, ["k"], [F.desc("n")])) == [
        (1, "c", 2),
        (None, "a", 1),
        (None, "a", 1),
    ]


def test_distinct_rows(spark):
    df = frame(spark, [(1, "a", 1), (1, "a", 2), (2, "a", 1)])
    assert distinct_rows(df, ["k", "v"]).count() == 2


TARGET = [(1, "a", 1), (2, "b", 2), (None, "t", 0)]


def test_merge_replaces_inserts_and_keeps_null_keys(spark, rows):
    source = frame(spark, [(2, "B", 20), (3, "c", 30), (None, "s", 9)])
    got = merge_frames(frame(spark, TARGET), source, ["k"])
    assert rows(got) == sorted(
        [(1, "a", 1), (2, "B", 20), (3, "c", 30), (None, "t", 0), (None, "s", 9)], key=repr
    )


def test_merge_column_rules(spark, rows):
    extra = spark.createDataFrame([(9, "E", "w", 1)], "n int, v string, more string, k int")
    assert (1, "E", 9) in rows(merge_frames(frame(spark, TARGET), extra, ["k"]))
    with pytest.raises(MissingColumns):
        merge_frames(frame(spark, TARGET), frame(spark, TARGET).drop("v"), ["k"])


def test_merge_with_nothing_is_identity(spark, rows):
    target = frame(spark, TARGET)
    assert rows(merge_frames(target, target.filter("k > 99"), ["k"])) == rows(target)


def test_merge_refuses_a_repeated_key(spark):
    twice = frame(spark, [(3, "a", 1), (3, "b", 1)])
    with pytest.raises(DuplicateKeys):
        merge_frames(frame(spark, TARGET), twice, ["k"])


def test_require_unique(spark):
    require_unique(frame(spark, [(None, "a", 1), (None, "b", 1), (1, "a", 1)]), ["k"])
    with pytest.raises(DuplicateKeys):
        require_unique(frame(spark, [(1, "a", 1), (1, "b", 1)]), ["k"])


def test_merge_does_not_shuffle_the_target_for_a_small_source(spark, tmp_path, final_plan):
    spark.range(1000).select("id", F.lit("x").alias("v")).write.parquet(str(tmp_path / "t"))
    spark.range(5).select("id", F.lit("y").alias("v")).write.parquet(str(tmp_path / "s"))
    merged = merge_frames(
        spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["id"]
    )
    plan = final_plan(merged)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abc"), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(row, max_size=12), source=st.lists(row, max_size=12))
def test_merge_against_plain_python(spark, target, source):
    unique, seen = [], set()
    for r in source:
        if r[0] is None or r[0] not in seen:
            seen.add(r[0])
            unique.append(r)
    keys = {r[0] for r in unique if r[0] is not None}
    expected = [r for r in target if r[0] is None or r[0] not in keys] + unique
    got = merge_frames(frame(spark, target), frame(spark, unique), ["k"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
