"""The stream of blog comments as a keyed landing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from zonewright import schemas
from zonewright.sources.store import TableStore
from zonewright.streaming.upsert import decode_messages, start_upsert

COMMENTS = "blog_comments"


def build_comments(
    messages: DataFrame, landing: TableStore, checkpoint: str, *, once: bool = False, every: str = "1 second"
) -> StreamingQuery:
    """Start the stream from ``messages`` (``value, partition, offset``, as ``read_topic`` gives
    them) into ``blog_comments``, keyed by comment; the last arrival wins. Messages that
    cannot be read, or have no id, go to ``rejects/blog_comments`` with their text."""
    decoded = decode_messages(messages, schemas.BLOG_COMMENT)
    return start_upsert(
        decoded, landing, COMMENTS, ["comment_id"], checkpoint, once=once, every=every
    )
