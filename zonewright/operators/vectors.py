"""Text embedding and exact nearest vectors by cosine."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from zonewright.functions.embedding import FeatureHashing

# A model: a function of a list of texts to a list of vectors. ``FeatureHashing`` needs none.
Embedder = Callable[[list[str]], Sequence[Sequence[float]]] | FeatureHashing

# Embedders travel to the tasks whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows one call of the embedder or of an external index gets.
BATCH_ROWS = 100
# Query vectors that are answered together: what a task holds beside a batch of vectors.
QUERY_ROWS = 1_000
# Bytes of query vectors in one cell of a grid, which its task holds.
CELL_BYTES = 16 * 1024 * 1024


def embed_texts(
    df: DataFrame,
    key: str,
    text: str,
    embedder: Embedder,
    *,
    out: str = "embedding",
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """``key, out``: the vector of every text of ``df``, whose ``key`` is one; a null text is an empty one.

    A model runs in the tasks. It is handed the texts only, at most ``batch_rows`` whole ones at a
    time. ``FeatureHashing`` counts words in the JVM.
    """
    if isinstance(embedder, FeatureHashing):
        return embedder.vectors(df, key, text, out)

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found: list[list[float]] = []
            for start in range(0, len(texts), batch_rows):
                part = texts.iloc[start : start + batch_rows].tolist()
                found += [[float(x) for x in vector] for vector in embedder(part)]
            yield pd.Series(found, dtype="object")

    return df.select(key, run(F.coalesce(F.col(text), F.lit(""))).alias(out))


def query_vector(spark: SparkSession, text: str, embedder: Embedder) -> list[float]:
    """The vector of one text, on the driver."""
    if not isinstance(embedder, FeatureHashing):
        return list(embedder([text])[0])
    one = spark.range(1).select("id", F.lit(text).alias("text"))
    return embed_texts(one, "id", "text", embedder).first()["embedding"]


def changed_items(items: DataFrame, known: DataFrame, id_column: str, hash_column: str) -> DataFrame:
    """Items that are new or whose text hash differs from the one stored."""
    return items.join(known.select(id_column, hash_column), [id_column, hash_column], "left_anti")


class _Nearest:
    """The ``k`` nearest of the vectors seen so far, for each query of one block. Queries are matched
    with vectors of their own length; a query without a direction is near nothing."""

    def __init__(self, queries: Sequence[Sequence[float] | None], k: int, digits: int | None) -> None:
        self._k, self._digits = k, digits
        self._held: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(queries)
        self._id_type: pa.DataType | None = None
        by_size: dict[int, list[int]] = {}
        for i, vector in enumerate(queries):
            if vector is not None and len(vector):
                by_size.setdefault(len(vector), []).append(i)
        self._blocks = []
        for size, places in by_size.items():
            block = np.asarray([queries[i] for i in places], dtype=np.float64)
            norms = np.linalg.norm(block, axis=1, keepdims=True)
            block = np.divide(block, norms, out=np.full_like(block, np.nan), where=norms > 0)
            self._blocks.append((size, places, block))

    def add(self, ids: pa.Array, vectors: pa.Array) -> None:
        """One matrix product for each length of vectors."""
        if not len(ids):
            return
        self._id_type = ids.type
        sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
        for size, places, block in self._blocks:
            rows = np.flatnonzero(sizes == size)
            if not len(rows):
                continue
            # A null element reads as NaN, which leaves its vector without a score.
            flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = flat.reshape(-1, size)
            with np.errstate(divide="ignore", invalid="ignore"):
                scores = (matrix @ block.T) / np.linalg.norm(matrix, axis=1)[:, None]
            if self._digits is not None:
                scores = np.round(scores, self._digits)
            names = ids.take(pa.array(rows)).to_numpy(zero_copy_only=False)
            for column, q in enumerate(places):
                self._held[q] = self._best(q, scores[:, column], names)

    def _best(self, q: int, scores: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = np.flatnonzero(~np.isnan(scores))
        scores, names = scores[there], names[there]
        if self._held[q] is not None:
            scores = np.concatenate((self._held[q][0], scores))
            names = np.concatenate((self._held[q][1], names))
        if len(scores) > self._k:
            bar = np.partition(scores, len(scores) - self._k)[len(scores) - self._k]
            best = np.flatnonzero(scores >= bar)
            best = best[np.lexsort((names[best], -scores[best]))[: self._k]]
            scores, names = scores[best], names[best]
        return scores, names

    def found(self) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        for q, held in enumerate(self._held):
            if held is not None and len(held[0]):
                yield q, pa.array(held[1], type=self._id_type), held[0]


def top_k(
    vectors: DataFrame,
    queries: Sequence[tuple[object, Sequence[float]]],
    k: int = 10,
    *,
    id_column: str = "id",
    vector_column: str = "embedding",
    query_column: str = "query_id",
    score_column: str = "score",
    score_digits: int | None = None,
    query_type: T.DataType | None = None,
) -> DataFrame:
    """The ``k`` nearest vectors of every query, exact, as ``(query, id, score, rank)``, for
    queries that the driver holds: they go to the tasks, and the vectors stay where they are.

    Each Arrow batch is one matrix product against the query block. A task keeps a
    running ``k`` best for each query over its batches, so what leaves it is ``k`` rows
    a query at most, whatever ``k`` is. Equal scores are ordered by id. A vector of length zero, of another
    size than the query, or null has no cosine and is never near. A query that is null or of
    length zero has no rows, and no queries give none.
    """
    blocks = [q[1] for q in queries]
    id_type = vectors.schema[id_column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(blocks, k, score_digits)
        for batch in batches:
            nearest.add(batch.column(0), batch.column(1))
        for q, ids, scores in nearest.found():
            place = pa.array(np.full(len(scores), q, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([place, ids, pa.array(scores)], names=["__q", id_column, score_column])

    sizes = sorted({len(v) for v in blocks if v is not None and len(v)})
    comparable = vectors.select(id_column, vector_column).filter(F.size(vector_column).isin(sizes) if sizes else F.lit(False))
    schema = T.StructType(
        [
            T.StructField("__q", T.IntegerType()),
            T.StructField(id_column, id_type),
            T.StructField(score_column, T.DoubleType()),
        ]
    )
    candidates = comparable.mapInArrow(run, schema)
    names = F.array(*[F.lit(q[0]) for q in queries])
    if query_type is not None or not queries:
        names = names.cast(T.ArrayType(query_type or T.StringType()))
    order = Window.partitionBy("__q").orderBy(F.desc(score_column), F.asc(id_column))
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.get(names, F.col("__q")).alias(query_column), id_column, score_column, "rank")
    )


def top_k_of(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    id_column: str = "id",
    vector_column: str = "embedding",
    query_id: str | None = None,
    query_column: str = "query_id",
    score_column: str = "score",
    score_digits: int | None = None,
    query_rows: int = QUERY_ROWS,
    vector_parts: int | None = None,
) -> DataFrame:
    """``top_k`` for all rows of ``queries``, however many; equal ones count once.

    Up to ``query_rows`` of them go to the tasks as they are. More are dealt into bands, and the vectors into
    ``vector_parts`` parts; every band meets every part in one cell of a grid. A cell's queries come first
    in its task, then its vectors stream past them, against ``query_rows`` queries at a time; it passes
    on ``k`` rows a query, and one ranking merges the parts. So both tables are scanned once, and a task
    holds one band of queries, ``CELL_BYTES`` or ``query_rows`` of them, and one batch of vectors. A vector is
    shuffled once for every band, a query once for every part: the grid has the form that makes these fewest.
    """
    named = query_id or id_column
    spark = vectors.sparkSession
    asked = queries.select(F.col(named).alias("q"), F.col(vector_column).alias("v")).filter(F.size("v") > 0).distinct()
    few = asked.limit(query_rows + 1).collect()
    if len(few) <= query_rows:
        return top_k(
            vectors, sorted(((r["q"], list(r["v"])) for r in few), key=repr), k,
            id_column=id_column, vector_column=vector_column, query_column=query_column, score_column=score_column,
            score_digits=score_digits, query_type=queries.schema[named].dataType,
        )
    told = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size")).first()
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    square = math.sqrt(tasks * told["n"] / max(vectors.count(), 1))
    bands = max(math.ceil(told["n"] / max(query_rows, CELL_BYTES // (8 * told["size"]))), min(round(square), tasks, math.ceil(told["n"] / query_rows)))
    parts = vector_parts or math.ceil(tasks / bands)
    cells = _grid(vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")), asked, bands, parts)
    schema = T.StructType(
        [
            T.StructField("q", queries.schema[named].dataType),
            T.StructField("h", T.LongType()),
            T.StructField("id", vectors.schema[id_column].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    order = Window.partitionBy("q", "h").orderBy(F.desc("score"), F.asc("id"))
    return (
        cells.mapInArrow(_cell_search(k, score_digits, query_rows), schema)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("q").alias(query_column), F.col("id").alias(id_column), F.col("score").alias(score_column), "rank")
    )


def _grid(vectors: DataFrame, asked: DataFrame, bands: int, parts: int) -> DataFrame:
    """Both tables as ``part, band, kind, id, v, q, h``, the cells one after the other in their tasks,
    queries (kind 0) before vectors (kind 1)."""

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    if vectors.schema["v"].dataType != asked.schema["v"].dataType:
        vectors, asked = (df.withColumn("v", F.col("v").cast("array<double>")) for df in (vectors, asked))
    # ``h`` tells queries apart that have one id and several vectors.
    told = asked.select("q", "v", F.xxhash64(F.col("v").cast("array<double>")).alias("h"))
    band = F.pmod(F.xxhash64("q", "h"), F.lit(bands)).cast("int")
    left = told.select(every(parts).alias("part"), band.alias("band"), F.lit(0).alias("kind"), "v", "q", "h")
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    right = vectors.filter(F.size("v") > 0).select(part.alias("part"), every(bands).alias("band"), F.lit(1).alias("kind"), "id", "v")
    both = left.unionByName(right, allowMissingColumns=True).select("part", "band", "kind", "id", "v", "q", "h")
    return both.repartition("part", "band").sortWithinPartitions("part", "band", "kind")


def _cell_search(k: int, digits: int | None, query_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: tuple[int, int] | None = None
        queries: list[tuple[pa.Array, pa.Array, pa.Array]] = []
        blocks: list[tuple[pa.Array, pa.Array, _Nearest]] = []

        def answered() -> Iterator[pa.RecordBatch]:
            for q, h, nearest in blocks:
                for place, ids, scores in nearest.found():
                    told = pa.array(np.full(len(scores), place))
                    yield pa.RecordBatch.from_arrays([q.take(told), h.take(told), ids, pa.array(scores)], names=["q", "h", "id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            ends = [*(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            start = 0
            for end in ends:
                part, band, kind = (int(x) for x in at[:, start])
                if (part, band) != cell:
                    yield from answered()
                    cell, queries, blocks = (part, band), [], []
                ids, v, q, h = (batch.column(i).slice(start, end - start) for i in range(3, 7))
                if kind == 0:
                    queries.append((q, h, v))
                elif queries or blocks:
                    if queries:
                        asked = [pa.concat_arrays([x[i] for x in queries]) for i in range(3)]
                        for first in range(0, len(asked[0]), query_rows):
                            some = [x.slice(first, query_rows) for x in asked]
                            blocks.append((some[0], some[1], _Nearest(some[2].to_pylist(), k, digits)))
                        queries = []
                    for _, _, nearest in blocks:
                        nearest.add(ids, v)
                start = end
        yield from answered()

    return run
