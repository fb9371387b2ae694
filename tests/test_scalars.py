from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zonewright.functions import scalars as S


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


KEYS = ["12", "abc", "", None, "3000000000", "7.9"]


def test_whole_number_is_strict(spark):
    assert values(spark, KEYS, S.whole_number) == [12, None, None, None, None, None]


def test_truncated_number_drops_the_fraction(spark):
    assert values(spark, KEYS, S.truncated_number) == [12, None, None, None, None, 7]


def test_grouped_number_reads_thousands_and_large_counts(spark):
    texts = ["1,868,413", "N/A", "73", None, "3000000000", ""]
    assert values(spark, texts, S.grouped_number) == [1868413, None, 73, None, 3000000000, None]


def test_amount_text(spark):
    assert values(spark, ["8.7", "1234.5", "N/A", None], S.amount_text) == [
        "8.70",
        "1,234.50",
        None,
        None,
    ]


def test_date_shape_and_real_dates(spark):
    texts = ["2024-01-31", "2024-99-99", "2024-1-1", None]
    assert values(spark, texts, S.iso_date_shaped) == [True, True, False, None]
    assert values(spark, texts, S.real_date) == [date(2024, 1, 31), None, None, None]


def test_url_or_null(spark):
    texts = ["http://x.io/a", "https://x.io", "ftp://x.io", "www.x.io", "http://x.io/a b", None]
    assert values(spark, texts, S.url_or_null) == texts[:3] + [None] * 3


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instant_is_the_same_in_every_session_zone(spark, zone):
    texts = [
        "2023-01-01T00:00:00.123Z",
        "2023-01-01T00:00:00Z",
        "2023-01-01T00:00:00+02:00",
        "garbage",
        "T10:00:00",
        None,
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = values(spark, texts, lambda t: F.unix_micros(S.instant(t)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    start = 1_672_531_200_000_000
    assert micros == [start + 123_000, start, start - 7_200_000_000, None, None, None]


def test_joined_key_skips_nulls(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert df.select(S.joined_key("a", "b", "c")).first()[0] == "1_x"


def test_url_parameter(spark):
    texts = ["https://y.com/watch?v=id", "https://y.com/watch?v=id&t=1", "https://youtu.be/id", None]
    assert values(spark, texts, S.url_parameter) == ["id", "id", None, None]
    assert values(spark, ["https://y.com/w?a=1&v=z#f"], S.url_parameter) == ["z"]


def test_video_url(spark):
    assert values(spark, ["k"], S.video_url) == ["https://www.youtube.com/watch?v=k"]


def test_item_text_leaves_nulls_out(spark):
    df = spark.createDataFrame([("T", None), ("T", "o")], "a string, b string")
    got = [r[0] for r in df.select(S.item_text(F.col("a"), F.col("b"))).collect()]
    assert sorted(got) == ["T", "T - o"]


def test_window_start(spark):
    got = spark.range(1).select(S.window_start(date(2024, 3, 5)), S.window_start("2024-03-05", 1))
    assert tuple(got.first()) == (date(2024, 2, 27), date(2024, 3, 4))


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(S.nan_to_null(F.col("x"))).collect()] == [None, 1.5, None]


def test_no_plain_cast_of_raw_values_raises_in_ansi_mode(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    raw = ["x", None, "9" * 30, "NaN"]
    for rule in (S.whole_number, S.truncated_number, S.grouped_number, S.amount_text, S.instant):
        values(spark, raw, rule)
    assert values(spark, ["2024-01-01T00:00:00Z"], S.instant) == [datetime(2024, 1, 1)]
