from pyspark.sql import functions as F

from zonewright.functions import scalars as S
from zonewright.operators.clean import (
    clean_entity,
    in_range,
    recast,
    require_castable,
    require_elements,
    require_filled,
    require_pattern,
    require_present,
    select_optional,
    split_quarantine,
)
from zonewright.operators.metrics import observe_rows, quality_counts


def raw(spark):
    return spark.createDataFrame(
        [
            ("12", "A", "2024-01-31", "5", '["US"]'),
            ("abc", "B", "2024-01-31", "5", None),
            ("13", "", "2024-01-31", "5", None),
            ("14", None, "2024-01-31", "5", None),
            ("15", "C", "2024-1-1", "5", None),
            ("16", "D", "2024-99-99", "N/A", None),
            (None, "E", None, None, None),
        ],
        "k string, title string, day string, n string, origin string",
    )


def test_clean_entity(spark, rows):
    got = clean_entity(
        raw(spark),
        key="k",
        required_text=["title"],
        numbers=["n"],
        iso_date="day",
        joined_lists=["origin"],
    )
    assert rows(got) == [
        (12, "A", "2024-01-31", 5.0, "US"),
        (16, "D", "2024-99-99", None, ""),
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") <= 1 and plan.count("Project") <= 1


def test_single_rules(spark, rows):
    df = raw(spark).select("k", "title", "day")
    assert {r[0] for r in rows(require_castable(df, "k"))} == {12, 13, 14, 15, 16}
    assert require_filled(df, ["k", "title"]).count() == 4
    assert require_present(df, ["k", "day", "title"]).count() == 5
    assert require_pattern(df, "day", S.ISO_DATE_SHAPE).count() == 5
    assert rows(recast(df.select("k"), {"k": "int"})) == sorted(
        [(12,), (None,), (13,), (14,), (15,), (16,), (None,)], key=repr
    )
    lists = spark.createDataFrame([([1],), ([],), (None,)], "l array<int>")
    assert require_elements(lists, "l").count() == 1


def test_quarantine_is_a_partition_of_the_input(spark, rows):
    df = raw(spark)
    good, bad = split_quarantine(
        df,
        {
            "key": F.col("k").try_cast("int").isNull(),
            "title": ~S.is_filled(F.col("title")),
        },
    )
    assert good.unionByName(bad.drop("reject_reason")).exceptAll(df).isEmpty()
    assert good.count() + bad.count() == df.count()
    reasons = {r["title"] or "none": r["reject_reason"] for r in bad.collect()}
    assert reasons == {"B": "key", "none": "title", "E": "key"}


def test_select_optional(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, extra int")
    wanted = {"a": "int", "b": "string", "c": "double"}
    assert select_optional(df, wanted).columns == ["a", "b"]
    strict = select_optional(df, wanted, rename={"c": "d"}, strict=True)
    assert strict.dtypes == [("a", "int"), ("b", "string"), ("d", "double")]
    assert strict.first()["d"] is None


def test_in_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.lit("ES").alias("region")).write.parquet(path)
    got = in_range(spark.read.parquet(path), "id", F.lit(10), F.lit(12), {"region": "ES"})
    assert sorted(r["id"] for r in got.collect()) == [10, 11, 12]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), IsNotNull(region)" in plan
    assert "GreaterThanOrEqual(id,10)" in plan and "EqualTo(reg" in plan


def test_quality_counts_and_observed_rows(spark, rows, tmp_path):
    df = raw(spark)
    got = quality_counts(
        df, {"all": F.count(F.lit(1)), "titled": F.count_if(S.is_filled(F.col("title")))}
    )
    assert rows(got) == [("all", 7), ("titled", 5)]
    assert str(got._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 1
    seen, observation = observe_rows(df, "seen")
    seen.write.parquet(str(tmp_path / "o"))
    assert observation.get == {"rows": 7}
    none, empty = observe_rows(df.filter("k = 'zzz'"), "none")
    none.write.parquet(str(tmp_path / "e"))
    assert empty.get == {"rows": 0}
