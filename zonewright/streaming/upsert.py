"""Message stream to keyed table: decode, keep the last per key, upsert.

No streaming state is kept. Late and replayed messages are simply upserted, the
last arrival wins, and a batch the engine repeats after a failure is recognised
by its number and not applied twice.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from zonewright.operators.dedup import all_present, keep_one_present
from zonewright.sources.files import Files
from zonewright.sources.store import TableStore

_TOPIC_COLUMNS = "value string, partition int, offset long"
_ARRIVAL = ("partition", "offset")
# The message as it came, for those that are set aside.
MESSAGE = "message_text"


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic from the earliest offset; the checkpoint resumes."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return reader.load().select(F.col("value").cast("string"), "partition", "offset")


def read_message_files(
    spark: SparkSession, folder: str, *, files_per_batch: int | None = None
) -> DataFrame:
    """The same columns from JSON files of ``{value, partition, offset}`` records."""
    reader = spark.readStream.schema(_TOPIC_COLUMNS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def decode_messages(messages: DataFrame, schema: str) -> DataFrame:
    """Payload fields next to ``partition`` and ``offset``, and the message itself in
    ``MESSAGE``. Unreadable payloads give rows of nulls but for that."""
    decoded = messages.select(F.from_json("value", schema).alias("payload"), F.col("value").alias(MESSAGE), *_ARRIVAL)
    return decoded.select("payload.*", *_ARRIVAL, MESSAGE)


def encode_messages(rows: DataFrame, offset: Column, partition: Column | None = None) -> DataFrame:
    """Rows as JSON payloads with the offset they would have in a topic."""
    part = partition if partition is not None else F.lit(0)
    return rows.select(
        F.to_json(F.struct(*rows.columns)).alias("value"),
        part.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
    )


def last_arrivals(
    batch: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str] = _ARRIVAL,
) -> DataFrame:
    """The last message of each key in one batch, without the arrival columns and the text.

    A producer that keys its messages has one partition per key, so the offset
    decides; over partitions the order is only made definite.
    """
    latest = keep_one_present(batch.drop(MESSAGE), keys, [F.desc(c) for c in arrival])
    return latest.drop(*_ARRIVAL, *arrival)


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave this checkpoint: the same after a restart, another one for
    a new checkpoint in the same place."""
    return json.loads(Files(spark).read_text(f"{checkpoint}/metadata"))["id"]


def start_upsert(
    messages: DataFrame,
    store: TableStore,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    *,
    arrival: Sequence[str] = _ARRIVAL,
    once: bool = False,
    every: str = "1 second",
    rejects: str | None = None,
) -> StreamingQuery:
    """Start the stream. Each micro-batch writes its own changed rows only.

    Messages without a full key (unreadable ones among them) go, with their text, to the
    table ``rejects``, by default ``rejects/<table>``, keyed by where they came from: a
    replay adds none.
    """
    spark = store.spark
    aside = rejects or f"rejects/{table}"

    def apply(batch: DataFrame, number: int) -> None:
        writer = (_stream_name(spark, checkpoint), number)
        readable = all_present(keys)
        missing = batch.filter(~readable).select(*_ARRIVAL, MESSAGE).dropDuplicates(list(_ARRIVAL))
        store.upsert(aside, missing, list(_ARRIVAL), writer=writer)
        batch = batch.filter(readable)
        store.upsert(table, last_arrivals(batch, keys, arrival), keys, writer=writer)

    trigger: Mapping[str, object] = {"availableNow": True} if once else {"processingTime": every}
    return (
        messages.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def without_replays(
    messages: DataFrame, event_time: str, delay: str, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """Optional thinning of heavy replays: drops a repeated ``(key, payload)`` within
    the watermark. It keeps state, and it loses rows later than ``delay``; the
    plain stream above does neither."""
    hashed = messages.withColumn(event_time, F.col(event_time).cast("timestamp")).withColumn(
        "__payload", F.xxhash64(*payload)
    )
    return (
        hashed.withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark([*keys, "__payload"])
        .drop("__payload")
    )
