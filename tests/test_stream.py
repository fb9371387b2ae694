import json
import os

from pyspark.sql import functions as F

from zonewright import schemas
from zonewright.sources.store import TableStore
from zonewright.streaming.upsert import (
    decode_messages,
    encode_messages,
    last_arrivals,
    read_message_files,
    start_upsert,
    without_replays,
)

KEYS = ["comment_id"]


def comment(key, text, minute=0):
    return {
        "tmdb_id": 1,
        "comment_id": key,
        "film_title": "F",
        "comment_text": text,
        "created_at": f"2024-01-01T00:{minute:02d}:00+02:00",
    }


class Topic:
    """Message files that appear in a folder like records of a topic."""

    def __init__(self, folder):
        self.folder, self.offset = folder, 0
        folder.mkdir()

    def send(self, *payloads):
        lines = []
        for payload in payloads:
            value = payload if isinstance(payload, str) else json.dumps(payload)
            lines.append(json.dumps({"value": value, "partition": 0, "offset": self.offset}))
            self.offset += 1
        path = self.folder / f"{self.offset:06d}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (self.offset, self.offset))  # files are taken in order of their time


def run(spark, topic, store, checkpoint, **options):
    messages = decode_messages(
        read_message_files(spark, str(topic.folder), files_per_batch=1), schemas.BLOG_COMMENT
    )
    query = start_upsert(messages, store, "comments", KEYS, str(checkpoint), once=True, **options)
    query.awaitTermination()


def texts(store):
    return {r["comment_id"]: r["comment_text"] for r in store.read("comments").collect()}


def test_stream_upserts_replays_and_restarts(spark, tmp_path):
    topic, store = Topic(tmp_path / "in"), TableStore(spark, str(tmp_path / "zone"))
    topic.send(comment("a", "1"), comment("b", "1"), comment("a", "2"))  # twice in one batch
    topic.send(comment("c", "late", minute=1), comment("b", "3"))  # changed payload
    run(spark, topic, store, tmp_path / "cp")
    assert texts(store) == {"a": "2", "b": "3", "c": "late"}
    commits = store._version("comments")
    run(spark, topic, store, tmp_path / "cp")  # restart with nothing new
    assert store._version("comments") == commits
    topic.send(comment("a", "2"), comment("b", "3"), comment("c", "late"))  # history replayed
    topic.send(comment("a", "4"))
    run(spark, topic, store, tmp_path / "cp")
    assert texts(store) == {"a": "4", "b": "3", "c": "late"}
    assert store.read("comments").count() == 3
    assert "created_at" in store.read("comments").columns
    assert "offset" not in store.read("comments").columns


def test_stream_equals_batch(spark, tmp_path):
    topic, store = Topic(tmp_path / "in"), TableStore(spark, str(tmp_path / "zone"))
    sent = []
    for batch in range(4):
        rows = [comment(f"k{(batch * 5 + i * 3) % 11}", f"{batch}-{i}") for i in range(6)]
        topic.send(*rows)
        sent += rows
    run(spark, topic, store, tmp_path / "cp")
    assert texts(store) == {r["comment_id"]: r["comment_text"] for r in sent}


def test_repeated_batch_number_is_not_applied_twice(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "zone"))
    topic = Topic(tmp_path / "in")
    topic.send({"tmdb_id": 1, "comment_text": "no key"})
    run(spark, topic, store, tmp_path / "cp")
    (done,) = (tmp_path / "cp" / "commits").glob("0")
    done.unlink()  # as if the process ended between our commit and the checkpoint's
    for crc in (tmp_path / "cp" / "commits").glob(".0.crc"):
        crc.unlink()
    run(spark, topic, store, tmp_path / "cp")
    assert not store.exists("comments")
    assert store.read("rejects/comments").count() == 1


def test_new_checkpoint_reads_from_the_start(spark, tmp_path):
    topic, store = Topic(tmp_path / "in"), TableStore(spark, str(tmp_path / "zone"))
    topic.send(comment("a", "1"))
    run(spark, topic, store, tmp_path / "cp1")
    topic.send(comment("a", "2"))
    run(spark, topic, store, tmp_path / "cp2")
    assert texts(store) == {"a": "2"}


def test_continuous_trigger(spark, tmp_path):
    topic, store = Topic(tmp_path / "in"), TableStore(spark, str(tmp_path / "zone"))
    topic.send(comment("a", "1"))
    messages = decode_messages(
        read_message_files(spark, str(topic.folder)), schemas.BLOG_COMMENT
    )
    query = start_upsert(
        messages, store, "comments", KEYS, str(tmp_path / "cp"), every="100 milliseconds"
    )
    try:
        query.processAllAvailable()
        topic.send(comment("a", "2"), comment("b", "1"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert texts(store) == {"a": "2", "b": "1"}


def test_rejects(spark, tmp_path):
    topic, store = Topic(tmp_path / "in"), TableStore(spark, str(tmp_path / "zone"))
    topic.send(comment("a", "1"), "{broken")
    topic.send({"film_title": "no id"})
    run(spark, topic, store, tmp_path / "cp", rejects="rejects/comments")
    assert texts(store) == {"a": "1"}
    aside = store.read("rejects/comments").orderBy("offset").collect()
    assert [(r["offset"], r["message_text"]) for r in aside] == [
        (1, "{broken"),
        (2, '{"film_title": "no id"}'),
    ]


def test_messages_roundtrip(spark, rows):
    df = spark.createDataFrame([(1, "a", "f", "t", None)], schemas.BLOG_COMMENT)
    sent = encode_messages(df, F.lit(3))
    assert sent.dtypes == [("value", "string"), ("partition", "int"), ("offset", "bigint")]
    back = decode_messages(sent, schemas.BLOG_COMMENT)
    assert rows(back.drop("message_text")) == [(1, "a", "f", "t", None, 0, 3)]


def test_last_arrivals_keeps_null_keys(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 0, 1), ("a", 2, 0, 2), (None, 3, 0, 3), (None, 3, 0, 4)],
        "k string, v int, partition int, offset long",
    )
    assert rows(last_arrivals(df, ["k"])) == [("a", 2), (None, 3), (None, 3)]


def test_optional_thinning(spark, tmp_path):
    events = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 00:00:00', 'x'),"
        " (1, TIMESTAMP_NTZ '2024-01-01 00:00:00', 'x'),"
        " (1, TIMESTAMP_NTZ '2024-01-01 00:00:01', 'y') AS t(k, ts, v)"
    )
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = (
        without_replays(stream, "ts", "10 minutes", ["k"], ["v"])
        .writeStream.format("memory")
        .queryName("thinned")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("thinned").count() == 2


def test_thinning_keeps_bounded_state(spark, tmp_path):
    def send(n, day, ids):
        rows = spark.createDataFrame([(i, f"2024-01-{day:02} 00:00:00", "p") for i in ids], "id long, at string, body string")
        encode_messages(rows.unionByName(rows), F.lit(n)).write.mode("append").json(str(tmp_path / "topic"))
        messages = decode_messages(read_message_files(spark, str(tmp_path / "topic")), "id long, at string, body string")
        running = (
            without_replays(messages, "at", "1 day", ["id"], ["body"])
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "passed"))
        )
        running.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"]][-1]

    held = [send(n, 1 + 3 * n, range(100 * n, 100 * n + 100)) for n in range(4)]
    assert max(held) <= 200  # keys older than the watermark are forgotten, however many came
    assert send(9, 1, [9999]) <= 200  # nine days late: lost
    passed = spark.read.parquet(str(tmp_path / "passed"))
    assert passed.count() == 400 and passed.filter("id = 9999").count() == 0
