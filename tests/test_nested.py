import json

import pytest
from pyspark.sql import functions as F

from zonewright import schemas
from zonewright.functions import collections as C
from zonewright.operators.nested import (
    decode_nested,
    encode_nested,
    explode_children,
    nested_list,
    normalize_nested,
    unnest_map,
)

GENRES = schemas.GENRES


def landing(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, j string")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('[{"id":1,"name":"a"}]', [(1, "a")]),
        ("{broken", []),
        ("", []),
        (None, []),
        ("null", []),
        ("NaN", []),
        ('["a","b"]', []),
        ('{"id":1,"name":"a"}', [(1, "a")]),
        ('[null,{"id":2,"name":"b"}]', [(None, None), (2, "b")]),
        ('[{"id":"12","name":"a"}]', [(None, "a")]),
        ('[{"id":99999999999,"name":"a"}]', [(None, "a")]),
        ("[]", []),
    ],
)
def test_parse_and_explode(spark, rows, text, expected):
    got = explode_children(landing(spark, [text]), ["k"], "j", GENRES, {"id": "id", "name": "name"})
    assert rows(got) == sorted([(0, *e) for e in expected], key=repr)


def test_explode_outer_keeps_childless_parents(spark, rows):
    df = landing(spark, ["[]", None, '[{"id":1,"name":"a"}]'])
    got = explode_children(df, ["k"], "j", GENRES, {"id": "id"}, outer=True)
    assert rows(got) == [(0, None), (1, None), (2, 1)]


def test_normalize_picks_one_name_and_keeps_roles_apart(spark, rows):
    credits = [
        {"id": 1, "role": "Acting", "character": "X", "name": "Zoe"},
        {"id": 1, "role": "Director", "character": None, "name": "Ann"},
        {"id": 2, "role": "Acting", "character": "Y", "name": None},
        None,
    ]
    df = spark.createDataFrame(
        [(10, json.dumps(credits)), (11, json.dumps(credits[:1])), (12, "[]")], "m int, c string"
    )
    links = explode_children(
        df,
        ["m"],
        "c",
        schemas.CREDITS,
        {"id": "id", "role": "role", "character": "character", "name": "name"},
    )
    dim, bridge = normalize_nested(
        links,
        dim_key=["id"],
        dim_columns=["name"],
        required_dim=["name"],
        bridge_key=["m", "id", "role"],
        bridge_columns=["character"],
    )
    assert rows(dim) == [(1, "Ann")]
    assert rows(bridge) == [
        (10, 1, "Acting", "X"),
        (10, 1, "Director", None),
        (10, 2, "Acting", "Y"),
        (11, 1, "Acting", "X"),
    ]


def test_bridge_keys_are_dimension_keys(spark):
    df = spark.range(200).select(
        F.col("id").alias("m"), (F.col("id") % 7).alias("d"), F.lit("n").alias("name")
    )
    dim, bridge = normalize_nested(df, dim_key=["d"], dim_columns=["name"], bridge_key=["m", "d"])
    assert bridge.join(dim, "d", "left_anti").isEmpty()
    assert dim.count() == 7


PROVIDERS = {
    "ES": {
        "link": "https://x",
        "flatrate": [{"provider_id": 1, "provider_name": "a"}, {"provider_id": 2}],
        "rent": [{"provider_id": 1, "provider_name": "a"}],
    },
    "US": {"buy": [{"provider_id": 9}]},
}
PROVIDER = "array<struct<provider_id:int,provider_name:string>>"


def test_unnest_map_reads_one_region_and_skips_the_link(spark, rows):
    df = landing(spark, [json.dumps(PROVIDERS), json.dumps({"US": PROVIDERS["US"]}), None])
    parsed = C.parse_json(F.col("j"), "map<string,map<string,string>>")
    options = {"outer_key": "ES", "skip": ["link"], "key_name": "kind"}
    got = unnest_map(df, ["k"], parsed, PROVIDER, **options)
    expected = [(0, "flatrate", 1, "a"), (0, "flatrate", 2, None), (0, "rent", 1, "a")]
    assert rows(got) == expected
    listed = df.select("k", nested_list(parsed, PROVIDER, **options).alias("l"))
    flat = listed.select("k", F.inline("l")).select("k", "kind", "provider_id", "provider_name")
    assert rows(flat) == expected


def test_encode_decode_roundtrip(spark, rows):
    df = spark.createDataFrame(
        [(1, [(1, "ä\n\"q\"")], {"a": 1.5}, ("x", None)), (2, None, None, None)],
        "k int, l array<struct<id:int,name:string>>, m map<string,double>, s struct<a:string,b:int>",
    )
    encoded = encode_nested(df)
    assert [t for _, t in encoded.dtypes] == ["int", "string", "string", "string"]
    back = decode_nested(
        encoded,
        {"l": GENRES, "m": "map<string,double>", "s": "struct<a:string,b:int>"},
    )
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows(back) == rows(df)


def test_array_rules(spark):
    df = spark.createDataFrame(
        [
            (
                [{"id": 1, "order": 0, "job": "Writer"}, {"id": 2, "order": 4, "job": "Director"},
                 {"id": 3, "order": 5, "job": "Director"}],
                [["a", "b"], [], ["c", "d"]],
            )
        ],
        "c array<struct<id:int,order:int,job:string>>, p array<array<string>>",
    )
    directors = C.first_where(F.col("c"), lambda e: e["job"] == "Director")
    nobody = C.first_where(F.col("c"), lambda e: e["job"] == "Cook")
    got = df.select(
        C.below_rank(F.col("c"), "order", 5)["id"].alias("low"),
        directors["id"].alias("first"),
        nobody.alias("none"),
        C.pick_fields(F.col("c"), {"n": "id", "kind": F.lit("k")}).alias("picked"),
        C.first_across_pages(F.col("p"), 3).alias("pages"),
        F.size(C.append_present(F.col("c"), nobody)).alias("kept"),
        F.size(C.append_present(F.col("c"), directors)).alias("longer"),
    ).first()
    assert got["low"] == [1, 2]
    assert got["first"] == 2 and got["none"] is None
    assert [tuple(p) for p in got["picked"]] == [(1, "k"), (2, "k"), (3, "k")]
    assert got["pages"] == ["a", "b", "c"]
    assert (got["kept"], got["longer"]) == (3, 4)


def test_joined_text_and_empty_default(spark):
    df = landing(spark, ['["US","FR"]', "[]", None, "x"])
    got = [r[0] for r in df.orderBy("k").select(C.joined_text(F.col("j"))).collect()]
    assert got == ["US&FR", "", "", ""]
    arrays = df.select(C.or_empty(F.lit(None).cast("array<int>"), "array<int>")).first()[0]
    assert arrays == []
