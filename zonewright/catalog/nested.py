"""Nested values: JSON in and out, unnesting, normalizing, picking from arrays.

Input arrays are made from one row's own columns or from a document's own lines,
so no group of rows is ever gathered to build them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.catalog.registry import query, table
from zonewright.functions import collections as C, scalars as S
from zonewright.operators.clean import require_filled, require_present
from zonewright.operators.dedup import keep_first, keep_one
from zonewright.operators.nested import (
    DimAndBridge,
    child,
    decode_nested,
    encode_nested,
    explode_children,
    normalize_nested,
    unnest_map,
)

LINES = "array<struct<line_no:int,line:string>>"
PARTIES = "array<struct<id:bigint,role:string,name:string>>"


def _document_lines(spark: SparkSession, folder: str) -> DataFrame:
    numbered = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(i.cast("int").alias("line_no"), line.alias("line")),
    )
    return table(spark, folder, "documents").select("doc_id", numbered.alias("lines"))


@query(
    "json_struct_extract",
    """
    SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
           json_extract_string(props, '$.absent') AS absent
    FROM events
    """,
)
def json_struct_extract(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "props")
    parsed = decode_nested(events, {"props": "struct<k:string,absent:string>"})
    return parsed.select(
        "event_id", S.whole_number(F.col("props.k")).alias("k"), F.col("props.absent")
    )


@query(
    "json_array_explode",
    """
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id, (unnest(generate_series(1, len(lines))) - 1)::INTEGER AS line_no,
           unnest(lines) AS line
    FROM d
    """,
)
def json_array_explode(spark: SparkSession, folder: str) -> DataFrame:
    landing = encode_nested(_document_lines(spark, folder))
    return explode_children(
        landing, ["doc_id"], "lines", LINES, {"line_no": "line_no", "line": "line"}
    )


def _order_parties(spark: SparkSession, folder: str) -> DimAndBridge:
    """Every order line names a part and a supplier, and a third, empty entry where
    nothing was returned: landing JSON, one list per line."""

    def party(role: str, id_column: str):
        name = F.concat_ws(" ", F.lit(role), F.col(id_column).cast("string"), "l_linestatus")
        return F.struct(
            F.col(id_column).alias("id"), F.lit(role).alias("role"), name.alias("name")
        )

    nobody = F.when(F.col("l_returnflag") == "R", party("returner", "l_suppkey"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.array(party("part", "l_partkey"), party("supplier", "l_suppkey"), nobody).alias("parties"),
    )
    links = explode_children(
        encode_nested(lines),
        ["l_orderkey"],
        "parties",
        PARTIES,
        {"id": "id", "role": "role", "name": "name"},
    )
    return normalize_nested(
        links,
        dim_key=["role", "id"],
        dim_columns=["name"],
        bridge_key=["l_orderkey", "role", "id"],
    )


_PARTIES_SQL = """
    WITH links AS (
      SELECT l_orderkey, 'part' AS role, l_partkey AS id, l_linestatus AS st FROM lineitem
      UNION ALL SELECT l_orderkey, 'supplier', l_suppkey, l_linestatus FROM lineitem
      UNION ALL SELECT l_orderkey, 'returner', l_suppkey, l_linestatus FROM lineitem
                WHERE l_returnflag = 'R')
"""


@query(
    "normalize_dim",
    _PARTIES_SQL + "SELECT role, id, min(role || ' ' || id || ' ' || st) AS name FROM links "
    "GROUP BY role, id",
)
def normalize_dim(spark: SparkSession, folder: str) -> DataFrame:
    return _order_parties(spark, folder).dim


@query(
    "normalize_bridge",
    _PARTIES_SQL
    + "SELECT DISTINCT l_orderkey, role, id, concat_ws('_', l_orderkey, role, id) AS link_id "
    "FROM links",
)
def normalize_bridge(spark: SparkSession, folder: str) -> DataFrame:
    bridge = _order_parties(spark, folder).bridge
    return bridge.withColumn("link_id", S.joined_key("l_orderkey", "role", "id"))


@query(
    "extract_children",
    """
    WITH raw AS (
      SELECT conv_id, CASE WHEN role = 'system' THEN '' ELSE role END AS author, text AS content,
             TIMESTAMP '2024-01-01' + to_hours(turn::INTEGER)
               - to_hours(CASE role WHEN 'assistant' THEN 2 ELSE 0 END) AS stamp
      FROM conversations)
    SELECT conv_id, author, min(content) AS content,
           strftime(stamp, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM raw WHERE author <> '' AND content <> '' GROUP BY conv_id, author, stamp
    """,
)
def extract_children(spark: SparkSession, folder: str) -> DataFrame:
    hours = F.make_interval(hours=F.col("turn").cast("int"))
    clock = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + hours
    zone = F.when(F.col("role") == "assistant", F.lit("+02:00")).otherwise(F.lit("Z"))
    stamp = F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSS"), zone)
    author = F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("role"))

    def entry(written_at):
        return F.struct(
            author.alias("author"), F.col("text").alias("content"), written_at.alias("created_at")
        )

    landing = encode_nested(
        table(spark, folder, "conversations").select(
            "conv_id", F.array(entry(stamp), entry(F.lit("yesterday"))).alias("entries")
        )
    )
    rows = explode_children(
        landing,
        ["conv_id"],
        "entries",
        "array<struct<author:string,content:string,created_at:string>>",
        {
            "author": "author",
            "content": "content",
            "created_at": S.instant(child("created_at")),
        },
    )
    kept = require_present(require_filled(rows, ["author", "content"]), ["created_at"])
    return keep_one(kept, ["conv_id", "author", "created_at"]).withColumn(
        "created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


_LINES_SQL = """
    WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, (unnest(generate_series(1, len(lines))) - 1)::INTEGER AS line_no,
                 unnest(lines) AS line FROM d)
"""


@query(
    "top_n_in_group",
    _LINES_SQL
    + """
    SELECT doc_id, 'head' AS role, line_no, line FROM l WHERE line_no < 5
    UNION ALL
    SELECT doc_id, 'number', min(line_no), arg_min(line, line_no) FROM l
    WHERE regexp_matches(line, '[0-9]{4}') GROUP BY doc_id
    """,
)
def top_n_in_group(spark: SparkSession, folder: str) -> DataFrame:
    head = C.pick_fields(
        C.below_rank(F.col("lines"), "line_no", 5),
        {"role": F.lit("head"), "line_no": "line_no", "line": "line"},
    )
    first = C.first_where(F.col("lines"), lambda e: e["line"].rlike("[0-9]{4}"))
    number = F.when(
        first.isNotNull(),
        F.struct(F.lit("number").alias("role"), first["line_no"].alias("line_no"), first["line"].alias("line")),
    )
    picked = _document_lines(spark, folder).select(
        "doc_id", C.append_present(head, number).alias("picked")
    )
    return explode_children(
        picked, ["doc_id"], "picked", None, {"role": "role", "line_no": "line_no", "line": "line"}
    )


@query(
    "first_match",
    _LINES_SQL
    + """
    , hit AS (SELECT doc_id, min(line_no) AS line_no, arg_min(line, line_no) AS line
              FROM l WHERE contains(line, '?') GROUP BY doc_id)
    SELECT documents.doc_id, coalesce(hit.line_no, -1) AS line_no, coalesce(hit.line, 'none') AS line
    FROM documents LEFT JOIN hit USING (doc_id)
    """,
)
def first_match(spark: SparkSession, folder: str) -> DataFrame:
    default = F.struct(F.lit(-1).alias("line_no"), F.lit("none").alias("line"))
    hit = F.coalesce(C.first_where(F.col("lines"), lambda e: e["line"].contains("?")), default)
    return _document_lines(spark, folder).select("doc_id", hit.alias("hit")).select("doc_id", "hit.*")


@query(
    "first_match_grouped",
    """
    SELECT conv_id, coalesce(arg_min(turn, turn) FILTER (role = 'assistant'), -1) AS turn,
           coalesce(arg_min(text, turn) FILTER (role = 'assistant'), 'none') AS answer
    FROM conversations GROUP BY conv_id
    """,
)
def first_match_grouped(spark: SparkSession, folder: str) -> DataFrame:
    answers = F.col("role") == "assistant"
    first = keep_one(
        table(spark, folder, "conversations"), ["conv_id"], [F.desc(answers), F.asc("turn")]
    )
    return first.select(
        "conv_id",
        F.when(answers, F.col("turn")).otherwise(F.lit(-1)).alias("turn"),
        F.when(answers, F.col("text")).otherwise(F.lit("none")).alias("answer"),
    )


@query(
    "limited_collect",
    """
    WITH ranked AS (
      SELECT conv_id, turn, role || ': ' || text AS said,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
      FROM conversations)
    SELECT conv_id, count(*) AS n_turns, string_agg(said, ' | ' ORDER BY turn) AS opening
    FROM ranked WHERE n <= 5 GROUP BY conv_id
    """,
)
def limited_collect(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.concat_ws(": ", "role", "text").alias("said")
    )
    opening = keep_first(turns, ["conv_id"], [F.asc("turn")], 5)
    gathered = opening.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("turn", "said"))).alias("turns"),
    )
    return gathered.select(
        "conv_id", "n_turns", F.array_join("turns.said", " | ").alias("opening")
    )


@query(
    "limited_pages",
    """
    WITH p AS (SELECT doc_id, [string_split(x, '. ') FOR x IN string_split(text, chr(10))] AS pages FROM documents)
    SELECT doc_id, array_to_string(list_slice(flatten(pages), 1, 5), ' | ') AS opening FROM p
    """,
)
def limited_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = F.transform(F.split("text", "\n", -1), lambda line: F.split(line, r"\. ", -1))
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(C.first_across_pages(pages, 5), " | ").alias("opening")
    )


@query(
    "unnest_map",
    """
    SELECT o_orderkey, 'buy' AS offer, o_custkey AS provider_id,
           'shop ' || o_orderstatus AS provider_name FROM orders
    UNION ALL SELECT o_orderkey, 'buy', o_custkey + 1, 'shop ' || o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'rent', o_orderkey, 'lender' FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def unnest_map_query(spark: SparkSession, folder: str) -> DataFrame:
    def shop(provider_id, name):
        return F.struct(
            provider_id.cast("bigint").alias("provider_id"), name.alias("provider_name")
        )

    buy = F.array(
        shop(F.col("o_custkey"), F.concat(F.lit("shop "), "o_orderstatus")),
        shop(F.col("o_custkey") + 1, F.concat(F.lit("shop "), "o_orderpriority")),
    )
    rent = F.when(
        F.col("o_orderstatus") != "P", F.array(shop(F.col("o_orderkey"), F.lit("lender")))
    )
    here = F.struct(
        F.lit("http://offers.example/x").alias("link"), buy.alias("buy"), rent.alias("rent")
    )
    there = F.struct(F.array(shop(F.lit(-1), F.lit("abroad"))).alias("buy"))
    landing = table(spark, folder, "orders").select(
        "o_orderkey", F.to_json(F.struct(here.alias("ES"), there.alias("US"))).alias("results")
    )
    return unnest_map(
        landing,
        ["o_orderkey"],
        C.parse_json(F.col("results"), "map<string,map<string,string>>"),
        "array<struct<provider_id:bigint,provider_name:string>>",
        outer_key="ES",
        skip=["link"],
        key_name="offer",
    )


@query(
    "array_join_text",
    """
    SELECT doc_id, CASE WHEN lang = 'de' THEN ''
                        ELSE lang || '&' || source || '&' || n_chars END AS origin
    FROM documents
    """,
)
def array_join_text(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.when(
        F.col("lang") != "de", F.array("lang", "source", F.col("n_chars").cast("string"))
    )
    landing = encode_nested(
        table(spark, folder, "documents").select("doc_id", listed.alias("origin"))
    )
    return landing.select("doc_id", C.joined_text(F.col("origin")).alias("origin"))


@query(
    "reshape_array",
    """
    SELECT conv_id, turn, role AS speaker, text AS said, 'chat' AS channel FROM conversations
    """,
)
def reshape_array(spark: SparkSession, folder: str) -> DataFrame:
    message = F.struct(
        "turn", F.struct(F.struct("role", "text").alias("body")).alias("payload"), "conv_id"
    )
    shaped = C.pick_fields(
        F.array(message),
        {
            "turn": "turn",
            "speaker": "payload.body.role",
            "said": "payload.body.text",
            "channel": F.lit("chat"),
        },
    )
    rows = table(spark, folder, "conversations").select("conv_id", shaped.alias("messages"))
    return rows.select("conv_id", F.inline("messages"))


@query(
    "json_roundtrip",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
    FROM events
    """,
)
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    whole = events.select(F.struct("*").alias("metadata"))
    schema = whole.schema["metadata"].dataType.simpleString()
    return decode_nested(encode_nested(whole), {"metadata": schema}).select("metadata.*")
