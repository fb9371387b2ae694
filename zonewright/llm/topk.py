"""Exact top-k by inner product with the three-phase uniform threshold algorithm."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonewright.llm.common import stage
from zonewright.llm.vectors import best_of_rows, first_copies, matrix, usable

K = 5
# A score is a sum over so many lists, each of a share of the dimensions.
LISTS = 2
# Queries that one pass over the rows answers; what the driver holds and sends out at a time.
QUERY_BLOCK = 4096
SCALE = 256
# Rows times queries scored at once in a task.
CELLS = 2_000_000
_NEVER = np.iinfo(np.int64).min // 64


class QueryBlock:
    """Queries of one length as a matrix, and their scores list by list."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, lists: int) -> None:
        self.keys, self.vectors = keys, vectors
        self.parts = [p for p in np.array_split(np.arange(vectors.shape[1]), lists) if len(p)]
        self.reach = int(np.abs(vectors).max(initial=0))

    def scores(self, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """``[list, query, row]``, exact; a query's own row gets a score that is never reached."""
        reach = self.reach * int(np.abs(rows).max(initial=0)) * rows.shape[1]
        if reach >= 1 << 62:
            raise ValueError("inner products of these vectors leave the range of a long")
        # Products of integers below 2**53 are exact in doubles, and those are faster.
        kind = "float64" if reach < 1 << 53 else "int64"
        a, b = self.vectors.astype(kind), rows.astype(kind)
        out = np.stack([a[:, p] @ b[:, p].T for p in self.parts]).astype("int64")
        out[:, self.keys[:, None] == keys[None, :]] = _NEVER
        return out

    def chunks(self, batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        batch = batch[batch["v"].map(len) == self.vectors.shape[1]]
        step = max(1, CELLS // len(self.keys))
        for at in range(0, len(batch), step):
            part = batch.iloc[at : at + step]
            keys = part["vec_id"].to_numpy(dtype="int64")
            yield keys, self.scores(matrix(part["v"], "int64"), keys)


def local_lists(rows: DataFrame, blocks: list[QueryBlock], k: int) -> DataFrame:
    """Phase one, in each task: the ``k`` best rows of each query's lists, with their whole scores."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A list's best so far: partial score, key, whole score.
        held = [[None] * len(b.parts) for b in blocks]
        for batch in batches:
            for n, block in enumerate(blocks):
                for keys, scores in block.chunks(batch):
                    whole = scores.sum(axis=0)
                    for j, part in enumerate(scores):
                        at, best = best_of_rows(part, keys, k)
                        new = (best, keys[at], np.take_along_axis(whole, at, axis=1))
                        if held[n][j] is not None:
                            new = tuple(np.concatenate(x, axis=1) for x in zip(held[n][j], new, strict=True))
                            at, best = best_of_rows(new[0], new[1], k)
                            new = (best, *(np.take_along_axis(x, at, axis=1) for x in new[1:]))
                        held[n][j] = new
        for n, block in enumerate(blocks):
            for best in held[n]:
                if best is not None:
                    real = best[0] > _NEVER
                    query = np.broadcast_to(block.keys[:, None], real.shape)[real]
                    yield pd.DataFrame({"query_id": query, "vec_id": best[1][real], "score": best[2][real]})

    return rows.mapInPandas(gather, "query_id long, vec_id long, score long")


def sufficient_entries(rows: DataFrame, blocks: list[QueryBlock], cutoff: dict[int, int]) -> DataFrame:
    """Phase two: the list entries of at least the ``m``-th part of the cutoff, ``m`` lists. A row
    without any has a score below the cutoff."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in blocks:
                least = np.array([cutoff.get(q, _NEVER) for q in block.keys.tolist()], dtype="int64")
                for keys, scores in block.chunks(batch):
                    lists, query, row = np.nonzero(
                        (scores * len(block.parts) >= least[None, :, None]) & (scores > _NEVER)
                    )
                    if len(query):
                        yield pd.DataFrame(
                            {
                                "query_id": block.keys[query], "vec_id": keys[row],
                                "part": scores[lists, query, row], "lists": np.int32(len(block.parts)),
                            }
                        )

    return rows.mapInPandas(collect, "query_id long, vec_id long, part long, lists int")


def resolved(pairs: DataFrame, rows: DataFrame, blocks: list[QueryBlock]) -> DataFrame:
    """Phase three: the whole scores of ``pairs``, looked up in ``rows``."""
    at = {int(q): (n, i) for n, b in enumerate(blocks) for i, q in enumerate(b.keys)}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = [at[q] for q in batch["query_id"]]
            for n, block in enumerate(blocks):
                mine = np.array([p[0] == n for p in place], dtype=bool)
                mine &= (batch["v"].map(len) == block.vectors.shape[1]).to_numpy(dtype=bool)
                if mine.any():
                    part = batch[mine]
                    ours = block.vectors[[place[i][1] for i in np.flatnonzero(mine)]]
                    whole = np.einsum("ij,ij->i", ours, matrix(part["v"], "int64"))
                    yield part[["query_id", "vec_id"]].assign(score=whole)

    return pairs.join(rows, "vec_id").mapInPandas(score, "query_id long, vec_id long, score long")


def kth_best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, v``, each key once: ``floor(scale * x)`` in double precision for every component."""
    grown = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("vec_id"), grown.alias("v")
    ).groupBy("vec_id").agg(F.min("v").alias("v"))


def exact_top_k(
    vectors: DataFrame, *, k: int = K, every: int = 50, lists: int = LISTS, scale: int = SCALE,
    query_block: int = QUERY_BLOCK, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows with the highest inner product of
    ``floor(scale * x)`` for each row whose key is divisible by ``every``; ties to the smaller key.

    The dimensions are cut into ``lists`` lists; a score is the sum over them. Phase one gathers
    each task's best entries of each list with their whole scores, whose ``k``-th best is a
    safe cutoff. Phase two sends the cutoff out and collects all entries of at least its
    ``lists``-th part: a row that has none cannot reach the cutoff. Phase three looks up the
    whole score of each row for which an entry is missing and that can still reach the ``k``-th
    best of those that are whole. Queries go in blocks of about ``query_block``, each with three
    passes; the driver holds one block and its cutoffs at a time.

    A row takes no part if its key or vector is null or holds a null or non-finite component.
    Rows that repeat a key count once, with the smallest of its vectors. Vectors of another
    length than the query's are no candidates, nor is an empty one. With fewer than ``k``
    candidates, all are returned. No rows, no result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, key, vector, scale)
    whole = stage(whole, "topk-vectors")
    rows = stage(first_copies(whole, "vec_id", "v", k + 1), "topk-rows")
    queries = whole.where(F.col("vec_id") % every == 0)
    blocks = math.ceil(queries.count() / query_block)
    found = []
    for n in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).orderBy("vec_id").toPandas()
        block = [
            QueryBlock(group["vec_id"].to_numpy("int64"), matrix(group["v"], "int64"), lists)
            for length, group in mine.groupby(mine["v"].map(len))
            if length
        ]
        gathered = local_lists(rows, block, k).dropDuplicates(["query_id", "vec_id", "score"])
        cutoff = {r["query_id"]: r["cutoff"] for r in kth_best(gathered, k).collect()}
        entries = sufficient_entries(rows, block, cutoff)
        seen = stage(
            entries.groupBy("query_id", "vec_id").agg(
                F.sum("part").alias("known"), F.count("*").alias("n"), F.max("lists").alias("lists")
            ),
            "topk-seen",
        )
        complete = seen.where("n = lists").select("query_id", "vec_id", F.col("known").alias("score"))
        first = spark.createDataFrame(list(cutoff.items()), "query_id long, cutoff long")
        better = kth_best(complete, k).unionByName(first).groupBy("query_id").agg(F.max("cutoff").alias("cutoff"))
        # What is not seen of a list is below its part of the first cutoff.
        most = F.col("known") + (F.col("lists") - F.col("n")) * F.ceil(F.col("cut_first") / F.col("lists"))
        open_ = (
            seen.where("n < lists")
            .join(first.withColumnRenamed("cutoff", "cut_first"), "query_id", "left")
            .join(better, "query_id", "left")
            .where(F.coalesce(most >= F.col("cutoff"), F.lit(True)))
            .select("query_id", "vec_id")
        )
        found.append(complete.unionByName(resolved(open_, rows, block)))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    scored = found[0]
    for more in found[1:]:
        scored = scored.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
