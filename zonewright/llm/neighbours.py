"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square test."""

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

K = 20
# Dimensions of the projection; even, for the chi-square distribution in closed form.
PROJECTED = 8
# A search stops where a neighbour still unseen would have shown up with this probability.
CONFIDENCE = 0.95
# Rows the upper levels of the tree are fitted on, and the most regions they make.
SAMPLE = 20_000
REGIONS = 1024
# Rows of a region that one task searches at a time, rows of a leaf, queries at a time.
BLOCK = 4096
LEAF = 64
QUERY_BLOCK = 4096
# Regions that a query searches a block of for a distance to start from. The better the start,
# the fewer rows of other blocks can still be among the best and leave their tasks.
HOME = 2
SEED = 7


def chi_square(x: float, freedom: int) -> float:
    """The distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < p else (low, mid)
    return high


class Projection:
    """Gaussian (2-stable) projections of vectors that are first brought to one norm.

    With a last component ``sqrt(bound**2 - |x|**2)`` for rows and 0 for queries, the largest inner
    product is the smallest distance: ``|q - x|**2 = |q|**2 + bound**2 - 2 q.x``. Divided by
    that distance, squared distances of projections are chi-square distributed.
    """

    def __init__(self, length: int, bound: float) -> None:
        self.bound = bound
        self.directions = np.random.default_rng(SEED).standard_normal((length + 1, PROJECTED))

    def rows(self, x: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(self.bound**2 - np.einsum("ij,ij->i", x, x), 0))
        return x @ self.directions[:-1] + last[:, None] * self.directions[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.directions[:-1]

    def squared(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance of a query and a row with that inner product."""
        return np.maximum(np.einsum("ij,ij->i", q, q) + self.bound**2 - 2 * score, 0)


def halve(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """A kd-tree of ``leaves`` (a power of two) leaves as a heap of cuts: the widest dimension
    of each node's points, at their median."""
    cuts, level = [], [points]
    while len(level) < leaves:
        below = []
        for part in level:
            dim = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
            at = float(np.median(part[:, dim])) if len(part) else 0.0
            cuts.append((dim, at))
            left = part[:, dim] < at
            below += [part[left], part[~left]]
        level = below
    return cuts


def leaf_of(points: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int64)
    if cuts:
        dims = np.array([c[0] for c in cuts])
        ats = np.array([c[1] for c in cuts])
        for _ in range(int(math.log2(len(cuts) + 1))):
            right = points[np.arange(len(points)), dims[node]] >= ats[node]
            node = 2 * node + 1 + right
    return node - len(cuts)


def box_squared(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``[point, box]``: squared distances, 0 inside."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    return out


class Held:
    """The best rows so far of some queries."""

    def __init__(self, queries: int, k: int) -> None:
        self.score = np.full((queries, k), -np.inf)
        self.key = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        both = np.concatenate((self.score[at], score), axis=1)
        keys = np.concatenate((self.key[at], np.broadcast_to(key, score.shape)), axis=1)
        chosen, best = best_of_rows(both, keys, self.score.shape[1])
        self.score[at] = best
        self.key[at] = np.take_along_axis(keys, chosen, axis=1)


def search_block(
    x: np.ndarray, keys: np.ndarray, p: np.ndarray, q: np.ndarray, own: np.ndarray, pq: np.ndarray,
    cutoff: np.ndarray, space: Projection, k: int, reach: float,
) -> Held:
    """Leaf by leaf, nearest first, for all queries ``q`` at once. A query is over once the next
    leaf's squared projected distance is ``reach`` (the chi-square quantile) times its ``k``-th
    squared distance or more; ``cutoff`` is a ``k``-th score it has from elsewhere."""
    leaves = 1 << max(0, math.ceil(math.log2(len(x) / LEAF)))
    leaf = leaf_of(p, halve(p, leaves))
    members = [m for m in (np.flatnonzero(leaf == n) for n in range(leaves)) if len(m)]
    low = np.stack([p[m].min(axis=0) for m in members])
    high = np.stack([p[m].max(axis=0) for m in members])
    away = box_squared(pq, low, high)
    turn = np.argsort(away, axis=1, kind="stable")
    held = Held(len(q), k)
    going = np.arange(len(q))
    for n in range(len(members)):
        known = np.maximum(held.score[going, -1], cutoff[going])
        limit = np.where(np.isfinite(known), reach * space.squared(q[going], np.where(np.isfinite(known), known, 0)), np.inf)
        going = going[away[going, turn[going, n]] <= limit]
        if not len(going):
            break
        nearest = turn[going, n]
        for which in np.unique(nearest):
            at, m = going[nearest == which], members[which]
            score = q[at] @ x[m].T
            score[own[at][:, None] == keys[m][None, :]] = -np.inf
            held.add(at, score, keys[m])
    return held


def nearest_by_inner_product(
    vectors: DataFrame, *, k: int = K, every: int = 20, confidence: float = CONFIDENCE,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``k`` rows with the largest inner products found for
    each row whose key is divisible by ``every``; ties to the smaller key.

    Vectors are projected to a few dimensions. The upper levels of a kd-tree over the
    projections are fitted on ``SAMPLE`` rows at most, chosen by hash; every row is put into
    its region, and each region is dealt into blocks of about ``BLOCK`` rows. A query first
    searches a block of each of the nearest regions, for a ``k``-th distance to start from. It
    then goes to all blocks whose region is near enough by the chi-square test, and searches
    each leaf by leaf, nearest first, until the test holds there: a row that is nearer than
    the ``k``-th found would have had a smaller projected distance with probability
    ``confidence``. So ``confidence`` is about the least recall to expect. Scores are the
    inner products of the original vectors in double precision, summed in one fixed order.

    A row takes no part if its key or vector is null, or the vector is empty, zero, or holds a
    null or non-finite component. Rows that repeat a key count once, with the smallest of its
    vectors. Vectors of another length than most are searched among their own length. With
    ``k`` candidates or fewer, all are returned. No rows, no result. Other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = (
        vectors.where(F.col(key).isNotNull() & usable(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0))
        .select(F.col(key).cast("long").alias("vec_id"), doubles.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )
    rows = stage(rows, "ann-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.max(norm).alias("bound"), F.count("*").alias("rows"))
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for length, bound, count in sorted(tuple(r) for r in lengths.collect()):
        own = rows.where(F.size("v") == length)
        # The bound is a little wide, so that rounding makes no root of a negative number.
        part = _search(own, Projection(length, bound * (1 + 1e-9)), count, k, every, confidence)
        found = found.unionByName(part)
    return found


def _search(rows: DataFrame, space: Projection, count: int, k: int, every: int, confidence: float) -> DataFrame:
    spark = rows.sparkSession
    reach = chi_square_quantile(confidence, PROJECTED)

    scale = 1 << 30
    sampled = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(scale)) < int(scale * min(1.0, SAMPLE / count)))
    sample = [r["v"] for r in sampled.select("v").limit(SAMPLE).collect()] or [rows.first()["v"]]
    regions = min(REGIONS, 1 << max(0, math.ceil(math.log2(count / BLOCK))))
    cuts = halve(space.rows(np.asarray(sample)), regions)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = space.rows(matrix(batch["v"]))
            yield batch.assign(p=list(p), region=leaf_of(p, cuts).astype("int32"))

    index = stage(
        first_copies(rows, "vec_id", "v", k + 1).mapInPandas(
            place, "vec_id long, v array<double>, p array<double>, region int"
        ),
        "ann-index",
    )
    box = [f(F.col("p")[d]).alias(f"{n}{d}") for n, f in (("low", F.min), ("high", F.max)) for d in range(PROJECTED)]
    known = index.groupBy("region").agg(F.count("*").alias("rows"), *box).orderBy("region").toPandas()
    low = known[[f"low{d}" for d in range(PROJECTED)]].to_numpy()
    high = known[[f"high{d}" for d in range(PROJECTED)]].to_numpy()
    blocks = np.ceil(known["rows"].to_numpy() / BLOCK).astype(int)
    # Block numbers run on from region to region.
    first = np.concatenate(([0], np.cumsum(blocks)))
    first_of = F.create_map(*[F.lit(int(x)) for pair in zip(known["region"], first[:-1], strict=True) for x in pair])
    blocks_of = F.create_map(*[F.lit(int(x)) for pair in zip(known["region"], blocks, strict=True) for x in pair])
    queries = rows.where(F.col("vec_id") % every == 0)
    groups = math.ceil(queries.count() / QUERY_BLOCK)
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed = index.withColumn(
        "block", first_of[F.col("region")] + F.pmod(F.xxhash64("vec_id"), blocks_of[F.col("region")]).cast("int")
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def route(batches: Iterator[pd.DataFrame], home: bool) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = matrix(batch["v"])
            for at in range(0, len(q), 256):
                some = batch.iloc[at : at + 256]
                away = box_squared(space.queries(q[at : at + 256]), low, high)
                if home:
                    near = away.argsort(axis=1, kind="stable")[:, :HOME]
                    to = first[near] + some["vec_id"].to_numpy("int64")[:, None] % blocks[near]
                    yield some.assign(cutoff=np.nan, to=to.tolist())
                else:
                    score = some["cutoff"].to_numpy()
                    limit = reach * space.squared(q[at : at + 256], np.nan_to_num(score))
                    open_ = (away <= limit[:, None]) | np.isnan(score)[:, None]
                    to = [[b for r in np.flatnonzero(o) for b in range(first[r], first[r + 1])] for o in open_]
                    yield some[["vec_id", "v", "cutoff"]].assign(to=to)

    def search(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if ours.empty or theirs.empty:
            return pd.DataFrame({n: pd.Series(dtype="float64" if n == "score" else "int64") for n in names})
        x, keys, q = matrix(ours["v"]), ours["vec_id"].to_numpy("int64"), matrix(theirs["v"])
        asked = theirs["vec_id"].to_numpy("int64")
        cutoff = theirs["cutoff"].to_numpy("float64", na_value=np.nan)
        # A little below, as the products summed here may differ in their last digits.
        cutoff = np.where(np.isnan(cutoff), -np.inf, cutoff - 1e-9 * (1 + np.abs(cutoff)))
        held = search_block(x, keys, matrix(ours["p"]), q, asked, space.queries(q), cutoff, space, k, reach)
        query, at = np.nonzero(np.isfinite(held.score) & (held.score >= cutoff[:, None]))
        key = held.key[query, at]
        order = np.argsort(keys)
        row = order[np.searchsorted(keys, key, sorter=order)]
        # Summed component by component, so that equal vectors have equal scores everywhere.
        score = np.zeros(len(query))
        for d in range(x.shape[1]):
            score += q[query, d] * x[row, d]
        return pd.DataFrame({"query_id": asked[query], "vec_id": key, "score": score})

    def searched(asked: DataFrame) -> DataFrame:
        sent = asked.withColumn("block", F.explode("to")).withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
        )
        return (
            placed.groupBy("block", "part")
            .cogroup(sent.drop("to").groupBy("block", "part"))
            .applyInPandas(search, "query_id long, vec_id long, score double")
        )

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    routed = "vec_id long, v array<double>, cutoff double, to array<int>"
    at_home = searched(queries.mapInPandas(lambda b: route(b, True), routed))
    start = (
        at_home.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") == k)
        .select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    )
    started = stage(queries.join(start, "vec_id", "left"), "ann-queries")
    return (
        searched(started.mapInPandas(lambda b: route(b, False), routed))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
