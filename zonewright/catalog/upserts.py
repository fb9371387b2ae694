"""Keyed upserts, as pure merges, through the table store, and from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.catalog.registry import query, table
from zonewright.operators.dedup import keep_one
from zonewright.operators.merge import merge_frames
from zonewright.plans.comments import COMMENTS, build_comments
from zonewright.session import work_folder
from zonewright.sources.store import TableStore
from zonewright.streaming.upsert import (
    decode_messages,
    encode_messages,
    read_message_files,
    start_upsert,
    without_replays,
)

_TARGET_SQL = """
    WITH target AS (
      SELECT o_orderkey AS k, o_orderstatus AS state, o_totalprice AS amount FROM orders),
    source AS (
      SELECT CASE WHEN l_returnflag = 'A' THEN -(l_orderkey + 1) ELSE l_orderkey END AS k,
             l_linestatus AS state, l_extendedprice AS amount
      FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (
              PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_linenumber,
              l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1))
"""
_MERGED_SQL = _TARGET_SQL + (
    "SELECT * FROM target WHERE k NOT IN (SELECT k FROM source) UNION ALL SELECT * FROM source"
)


def _target(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("amount"),
    )


def _source(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order from its lines: updates of known orders, and, with keys of
    their own, orders nobody knew."""
    latest = keep_one(table(spark, folder, "lineitem"), ["l_orderkey"], [F.desc("l_shipdate")])
    key = F.when(F.col("l_returnflag") == "A", -(F.col("l_orderkey") + 1)).otherwise(
        F.col("l_orderkey")
    )
    return latest.select(
        key.alias("k"), F.col("l_linestatus").alias("state"), F.col("l_extendedprice").alias("amount")
    )


@query("upsert_merge", _MERGED_SQL)
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merge_frames(_target(spark, folder), _source(spark, folder), ["k"])


@query("upsert_idempotent", _MERGED_SQL)
def upsert_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert twice, through a stored table."""
    store = TableStore(spark, work_folder(spark, "upsert"))
    store.create("orders", _target(spark, folder), keys=["k"])
    changes = _source(spark, folder)
    store.upsert("orders", changes, ["k"])
    store.upsert("orders", changes, ["k"])
    return store.read("orders")


@query(
    "upsert_null_keys",
    """
    WITH target AS (
      SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_totalprice AS amount
      FROM orders),
    source AS (
      SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS k, c_acctbal AS amount
      FROM customer)
    SELECT k::DOUBLE AS k, amount FROM target
    WHERE k IS NULL OR NOT EXISTS (SELECT 1 FROM source WHERE source.k = target.k)
    UNION ALL SELECT k::DOUBLE, amount FROM source
    """,
)
def upsert_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    target = table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("k"),
        F.col("o_totalprice").alias("amount"),
    )
    source = table(spark, folder, "customer").select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("k"),
        F.col("c_acctbal").alias("amount"),
    )
    return merge_frames(target, source, ["k"]).withColumn("k", F.col("k").cast("double"))


@query(
    "upsert_empty",
    "SELECT o_orderkey AS k, o_orderstatus AS state, o_totalprice AS amount FROM orders",
)
def upsert_empty(spark: SparkSession, folder: str) -> DataFrame:
    store = TableStore(spark, work_folder(spark, "upsert-empty"))
    store.create("orders", _target(spark, folder), keys=["k"])
    store.upsert("orders", _source(spark, folder).filter(F.col("amount") < 0), ["k"])
    return store.read("orders")


@query(
    "store_history",
    _TARGET_SQL
    + """
    , merged AS (SELECT * FROM target WHERE k NOT IN (SELECT k FROM source)
                 UNION ALL SELECT * FROM source)
    SELECT merged.k, CASE WHEN c_custkey IS NULL THEN state ELSE 'C' END AS state,
           coalesce(c_acctbal, amount) AS amount
    FROM merged LEFT JOIN customer ON merged.k = c_custkey
    """,
)
def store_history(spark: SparkSession, folder: str) -> DataFrame:
    """Create, and two different upserts one after the other."""
    store = TableStore(spark, work_folder(spark, "history"))
    store.create("orders", _target(spark, folder), keys=["k"])
    store.upsert("orders", _source(spark, folder), ["k"])
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.lit("C").alias("state"), F.col("c_acctbal").alias("amount")
    )
    store.upsert("orders", customers, ["k"])
    return store.read("orders")


@query(
    "store_lifecycle",
    """
    SELECT 'before' AS step, false AS present, 0::BIGINT AS n
    UNION ALL SELECT 'created', true, count(*) FROM orders
    UNION ALL SELECT 'appended', true, (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'dropped', false, 0
    """,
)
def store_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the table is there and how many rows ``show`` counts, step by step."""
    store = TableStore(spark, work_folder(spark, "lifecycle"))
    seen: list[tuple[str, bool, int]] = []

    def look(step: str) -> None:
        present = store.exists("orders")
        seen.append((step, present, store.show("orders", 1) if present else 0))

    look("before")
    store.create("orders", _target(spark, folder), keys=["k"])
    look("created")
    more = table(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("k"), F.lit("S").alias("state"), F.col("s_acctbal").alias("amount")
    )
    store.create("orders", more, mode="append")
    look("appended")
    store.drop("orders")
    look("dropped")
    return spark.createDataFrame(seen, "step string, present boolean, n long")


@query(
    "stream_upsert",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value
    FROM events
    """,
)
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives as an early draft and in its final form in the same batch;
    the stream stops, resumes from its checkpoint, and all final forms come again."""
    work = work_folder(spark, "stream")
    events = table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        "value",
    )
    drafts = events.withColumn("value", F.col("value") - 1).withColumn("event_type", F.lit("draft"))
    first = encode_messages(drafts, F.lit(1)).unionByName(encode_messages(events, F.lit(2)))
    store = TableStore(spark, f"{work}/zone")
    for sent in (first, encode_messages(events, F.lit(3))):
        sent.write.mode("append").json(f"{work}/topic")
        messages = decode_messages(
            read_message_files(spark, f"{work}/topic"), events.schema.simpleString()
        )
        running = start_upsert(
            messages, store, "events", ["event_id"], f"{work}/checkpoint", once=True
        )
        running.awaitTermination()
    return store.read("events")


@query(
    "stream_thinned",
    """
    SELECT event_id::BIGINT AS event_id, event_type, value FROM events
    UNION ALL SELECT event_id::BIGINT, 'draft', value - 1 FROM events
    UNION ALL SELECT event_id::BIGINT + 2000000000, event_type, value FROM events
    """,
)
def stream_thinned(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives three times in two forms; each form passes once. After a restart all come
    again, with new ones that are too late, which are lost, and new ones in time, which pass."""
    work = work_folder(spark, "thinned")
    events = table(spark, folder, "events").select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "event_type",
        "value",
    )
    drafts = events.withColumn("value", F.col("value") - 1).withColumn("event_type", F.lit("draft"))
    sent = drafts.unionByName(events).unionByName(events).unionByName(drafts)
    late = events.withColumns({"event_id": F.col("event_id") + 1_000_000_000, "ts": F.lit("1990-01-01 00:00:00")})
    fresh = events.withColumns({"event_id": F.col("event_id") + 2_000_000_000, "ts": F.lit("2090-01-01 00:00:00")})
    for number, rows in enumerate((sent, sent.unionByName(late).unionByName(fresh).unionByName(fresh))):
        encode_messages(rows, F.lit(number)).write.mode("append").json(f"{work}/topic")
        messages = decode_messages(read_message_files(spark, f"{work}/topic"), events.schema.simpleString())
        thinned = without_replays(messages, "ts", "1 day", ["event_id"], ["event_type", "value"])
        running = (
            thinned.select("event_id", "event_type", "value")
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{work}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{work}/passed")
        )
        running.awaitTermination()
    return spark.read.parquet(f"{work}/passed")


def _sent_comments(spark: SparkSession, folder: str) -> TableStore:
    """Turns of conversations as blog comments, sent twice and edited in between; every third
    conversation's first turn also comes as a line that is no JSON. The landing table."""
    work = work_folder(spark, "comments")
    turns = table(spark, folder, "conversations")
    comments = turns.select(
        F.col("conv_id").cast("int").alias("tmdb_id"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("role").alias("film_title"),
        F.col("text").alias("comment_text"),
        F.lit("2024-01-01T10:00:00+02:00").alias("created_at"),
    )
    broken = turns.filter("turn = 0 AND conv_id % 3 = 0").select(
        F.concat(F.lit("{broken "), F.col("conv_id").cast("string")).alias("value"),
        F.lit(1).alias("partition"),
        F.col("conv_id").cast("long").alias("offset"),
    )
    drafts = comments.withColumn("comment_text", F.lit("draft"))
    store = TableStore(spark, f"{work}/zone")
    for number, sent in enumerate((drafts, comments)):
        lines = encode_messages(sent, F.lit(number)).unionByName(broken)
        lines.write.mode("append").json(f"{work}/topic")
        running = build_comments(
            read_message_files(spark, f"{work}/topic"), store, f"{work}/checkpoint", once=True
        )
        running.awaitTermination()
    return store


@query(
    "stream_comments",
    """
    SELECT DISTINCT conv_id::INTEGER AS tmdb_id, conv_id || '-' || turn AS comment_id, role AS film_title,
           text AS comment_text, '2024-01-01 08:00:00' AS created_at
    FROM conversations
    """,
)
def stream_comments(spark: SparkSession, folder: str) -> DataFrame:
    store = _sent_comments(spark, folder)
    return store.read(COMMENTS).withColumn(
        "created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stream_rejects",
    """
    SELECT DISTINCT 1 AS partition, conv_id::BIGINT AS "offset", '{broken ' || conv_id AS message_text
    FROM conversations WHERE turn = 0 AND conv_id % 3 = 0
    """,
)
def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable messages, with their text; the replay adds none."""
    store = _sent_comments(spark, folder)
    return store.read(f"rejects/{COMMENTS}")
