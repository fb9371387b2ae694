"""Row-wise external sinks, fed from the executors in bounded batches.

A task may run twice when an executor is lost. ``relational_upsert`` and ``index_upsert`` are keyed:
writing a batch again leaves the same rows behind, but what a failed job has written stays.
``handed_over`` shows the target nothing until all tasks have succeeded.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def batches(rows: Iterable[Any], size: int) -> Iterator[list[Any]]:
    iterator = iter(rows)
    while batch := list(islice(iterator, size)):
        yield batch


def conflict_upsert(
    table: str, columns: Sequence[str], keys: Sequence[str], placeholder: str = "?"
) -> str:
    """INSERT that replaces the row a key already has."""
    values = ", ".join([placeholder] * len(columns))
    others = [c for c in columns if c not in keys]
    action = (
        "UPDATE SET " + ", ".join(f"{c} = excluded.{c}" for c in others) if others else "NOTHING"
    )
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({values}) "
        f"ON CONFLICT ({', '.join(keys)}) DO {action}"
    )


def relational_upsert(
    df: DataFrame,
    connect: Callable[[], Any],
    table: str,
    keys: Sequence[str],
    *,
    batch_rows: int = 500,
    connections: int | None = None,
    placeholder: str = "?",
) -> None:
    """Upsert rows over connections the tasks open themselves, one per partition.

    ``connect`` returns a DB-API connection. Every batch is its own transaction.
    ``connections`` bounds how many are open: rows are then spread by key, so what
    comes before keeps its parallelism and no two connections lock the same row.
    """
    statement = conflict_upsert(table, df.columns, keys, placeholder)

    def send(rows: Iterator[Row]) -> None:
        connection = None
        try:
            for batch in batches(rows, batch_rows):
                connection = connection or connect()
                connection.cursor().executemany(statement, [tuple(r) for r in batch])
                connection.commit()
        finally:
            if connection is not None:
                connection.close()

    (df.repartition(connections, *keys) if connections else df).foreachPartition(send)


def handed_over(
    df: DataFrame,
    connect: Callable[[], Any],
    table: str,
    keys: Sequence[str],
    *,
    batch_rows: int = 500,
    connections: int | None = None,
    placeholder: str = "?",
) -> int:
    """Upsert rows in two steps, so that a task or a job that fails leaves ``table`` as it was; rows
    handed over.

    Tasks write to a staging table beside the target, each row marked with its partition and
    the attempt at it. What comes back to the driver is the attempt that won for each partition, and
    how many rows it wrote. One transaction then upserts the winners' rows by key and drops
    the staging table; rows of lost attempts are never seen. Keys must not repeat in ``df``.
    """
    staging = f"{table}_staged_{uuid.uuid4().hex}"
    winners = f"{staging}_won"
    columns = ", ".join(df.columns)
    marks = ", ".join([placeholder] * (len(df.columns) + 2))
    insert = f"INSERT INTO {staging} (part_no, attempt_no, {columns}) VALUES ({marks})"

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt, sent = task.partitionId(), task.taskAttemptId(), 0
        connection = None
        try:
            for batch in rows:
                for start in range(0, batch.num_rows, batch_rows):
                    connection = connection or connect()
                    some = batch.slice(start, batch_rows).to_pylist()
                    connection.cursor().executemany(insert, [(part, attempt, *row.values()) for row in some])
                    connection.commit()
                    sent += len(some)
        finally:
            if connection is not None:
                connection.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "attempt": [attempt], "sent": [sent]})

    def run(*statements: str) -> None:
        """Statements as one transaction on the driver."""
        connection = connect()
        try:
            for statement in statements:
                connection.cursor().execute(statement)
            connection.commit()
        finally:
            connection.close()

    run(f"CREATE TABLE {staging} AS SELECT 0 AS part_no, 0 AS attempt_no, {columns} FROM {table} WHERE 1 = 0")
    try:
        spread = df.repartition(connections, *keys) if connections else df
        won = spread.mapInArrow(send, "part long, attempt long, sent long").collect()
        run(f"CREATE TABLE {winners} AS SELECT part_no, attempt_no FROM {staging} WHERE 1 = 0")
        connection = connect()
        try:
            cursor = connection.cursor()
            cursor.executemany(
                f"INSERT INTO {winners} (part_no, attempt_no) VALUES ({placeholder}, {placeholder})",
                [(r["part"], r["attempt"]) for r in won],
            )
            head, _, action = conflict_upsert(table, df.columns, keys, placeholder).partition(" ON CONFLICT ")
            cursor.execute(
                f"{head.partition(' VALUES ')[0]} SELECT {columns} FROM {staging} s WHERE EXISTS (SELECT 1 FROM {winners} w "
                f"WHERE w.part_no = s.part_no AND w.attempt_no = s.attempt_no) ON CONFLICT {action}"
            )
            connection.commit()
        finally:
            connection.close()
        return sum(r["sent"] for r in won)
    finally:
        run(f"DROP TABLE IF EXISTS {winners}", f"DROP TABLE IF EXISTS {staging}")


def index_upsert(
    df: DataFrame,
    open_index: Callable[[], Any],
    *,
    id_column: str = "id",
    vector_column: str = "embedding",
    metadata_column: str = "metadata",
    batch_rows: int = 100,
) -> None:
    """Upsert ``(id, vector, metadata)`` items into an external vector index whose
    handle has ``upsert(items)``; ``open_index`` is called once per partition."""
    items = df.select(id_column, vector_column, metadata_column)

    def send(rows: Iterator[Row]) -> None:
        index = None
        for batch in batches(rows, batch_rows):
            index = index or open_index()
            index.upsert([(r[0], list(r[1]), r[2].asDict(recursive=True)) for r in batch])

    items.foreachPartition(send)
