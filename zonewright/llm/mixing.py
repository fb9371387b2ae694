"""Source mixtures by temperature: exponents on token shares, realised as block permutations.

All work is done by SQL functions; neither rows nor sources are gathered anywhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonewright.llm.common import stage, text_or_empty

MAX_REPEATS = 2.0
# Tokens of all sources together in a block.
BLOCK_TOKENS = 1_000_000
# Rows of one source and pass that are put in order at a time.
BUCKET_ROWS = 2000
# Each pass over the sources narrows the exponent's interval to a 16th: four bisections at once.
PARTS = 16
PASSES = 8


@dataclass(frozen=True)
class Mixture:
    """Weights are ``share ** exponent / norm``; ``budget`` is in tokens."""

    exponent: float
    norm: float
    budget: float
    total: int


def token_count(text: Column) -> Column:
    """White-space separated words, the measure that shares and budgets are in."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def source_sizes(rows: DataFrame, source: str, tokens: str) -> DataFrame:
    """``source, tokens, rows`` of the sources that have tokens; null is a source of its own."""
    sizes = rows.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("rows"))
    return stage(sizes.where("tokens > 0"), "mix-sources")


def _measured(sizes: DataFrame, total: int, exponents: list[float]) -> list:
    """For each exponent, what entropy and repetitions follow from, over all sources at once."""
    share = F.col("tokens") / F.lit(total)
    power = F.exp(F.col("exponent") * F.log("share"))
    return (
        sizes.withColumn("share", share)
        .withColumn("exponent", F.explode(F.array(*[F.lit(float(e)) for e in exponents])))
        .withColumn("power", power)
        .groupBy("exponent")
        .agg(
            F.sum("power").alias("norm"),
            F.sum(F.col("power") * F.log("share")).alias("logs"),
            F.max(F.col("power") / F.col("tokens")).alias("most"),
            F.min(F.col("power") / F.col("tokens")).alias("least"),
        )
        .orderBy("exponent")
        .collect()
    )


def temper(
    sizes: DataFrame, *, budget: float | None = None, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS
) -> Mixture:
    """The smallest exponent from 0 (all sources alike) to 1 (as they are) whose weights have
    ``target_entropy`` (natural logarithm) or less and repeat no source more than
    ``max_repeats`` times. If even 1 does not meet them, it is 1. Without a ``budget``, it is the
    smallest with which every source is taken whole at least once."""
    total = int(sizes.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return Mixture(1.0, 1.0, 0.0, 0)

    def spent(r) -> float:
        return budget if budget is not None else r["norm"] / r["least"]

    def fits(r) -> bool:
        entropy = math.log(r["norm"]) - r["exponent"] * r["logs"] / r["norm"]
        repeats = r["most"] / r["norm"] * spent(r)
        slack = 1 + 1e-9
        return (target_entropy is None or entropy <= target_entropy * slack) and (
            max_repeats is None or repeats <= max_repeats * slack
        )

    low, high = 0.0, 1.0
    for n in range(PASSES):
        steps = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        measured = _measured(sizes, total, steps)
        at = next((i for i, r in enumerate(measured) if fits(r)), PARTS)
        best = measured[at]
        if at == 0 or (n == 0 and not fits(best)):
            break
        low, high = steps[at - 1], steps[at]
    return Mixture(best["exponent"], best["norm"], float(spent(best)), total)


def mixed(
    rows: DataFrame, sizes: DataFrame, mixture: Mixture, *, key: str, source: str, tokens: str,
    block_tokens: int = BLOCK_TOKENS, bucket_rows: int = BUCKET_ROWS, seed: int = 1,
) -> DataFrame:
    """``rows`` as often as the mixture takes them, with ``pass``, ``block`` and ``order_key``.

    A source's quota is its weight times the budget. It is filled by whole passes over the
    source, each in an order of its own by hash, and by the beginning of one more: the rows
    that end within what is left. A row's block follows from where in its source's quota it
    begins, so every block has all sources by their weights, to within a row of each; inside
    a block, ``order_key`` is the order.

    Running sums are taken over buckets of a source's order first, then inside each bucket: so
    no task orders a whole source.
    """
    weight = F.exp(F.lit(mixture.exponent) * F.log(F.col("tokens") / F.lit(max(1, mixture.total)))) / F.lit(mixture.norm)
    # Rounded so that a quota of whole passes is not cut short in its last digits.
    quota = F.round(weight * F.lit(mixture.budget), 3)
    plan = sizes.select(
        F.col("source").alias("s_source"), F.col("tokens").alias("s_tokens"), quota.alias("s_quota"),
        F.ceil(F.col("rows") / bucket_rows).cast("int").alias("s_buckets"),
    ).where("s_quota > 0")
    blocks = max(1, math.ceil(mixture.budget / block_tokens - 1e-6))
    # Dealt by something else than the source, so that the join gets plain exchanges and a
    # large source can be split.
    plan = plan.repartition("s_tokens")
    # The top bits of the order give the bucket, so buckets are in order too.
    fraction = (F.col("order_key").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    taken = (
        rows.join(plan, rows[source].eqNullSafe(plan["s_source"]))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.ceil(F.col("s_quota") / F.col("s_tokens")).cast("int") - 1)))
        .withColumn("order_key", F.xxhash64(F.lit(seed), "pass", key, tokens))
        .withColumn("bucket", F.least(F.floor(fraction * F.col("s_buckets")).cast("int"), F.col("s_buckets") - 1))
    )
    at = ["s_source", "pass", "bucket"]
    sums = taken.groupBy(*at).agg(F.sum(tokens).alias("in_bucket"))
    earlier = Window.partitionBy("s_source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        *[F.col(c).alias(f"b_{c}") for c in at], F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("b_before")
    )
    same = F.lit(True)
    for c in at:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    inside = Window.partitionBy(*at).orderBy("order_key", key).rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("pass") * F.col("s_tokens") + F.col("b_before") + F.sum(tokens).over(inside)
    block = F.floor((F.col("end") - F.col(tokens)) / F.col("s_quota") * blocks).cast("int")
    return (
        taken.join(before, same)
        .withColumn("end", end)
        .where(F.col("end") <= F.col("s_quota") + 0.5)
        .withColumn("block", F.least(block, F.lit(blocks - 1)))
        .select(*rows.columns, "pass", "block", "order_key")
    )


def mix_documents(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source",
    budget: float | None = None, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
) -> DataFrame:
    """``key, source, n_tokens, pass, block, order_key``: a row for each time a document is taken.

    Weights are the sources' token shares to a power below 1, normalised; the power is bisected
    to the smallest with the wanted entropy or repetitions (``temper``). Without a budget no
    source loses a document: the largest is taken once, the others up to ``max_repeats`` times.

    A null source is a source of its own; a null or empty text has no tokens and comes with
    every pass that reaches it; a source without any token has no weight and no rows; a null
    key stays; repeated rows are rows of their own; no rows give no rows. Other columns are
    not looked at.
    """
    rows = stage(
        docs.select(F.col(key).alias("k"), F.col(source).alias("source"), token_count(text_or_empty(text)).alias("n_tokens")),
        "mix-rows",
    )
    sizes = source_sizes(rows, "source", "n_tokens")
    mixture = temper(sizes, budget=budget, target_entropy=target_entropy, max_repeats=max_repeats)
    return mixed(rows, sizes, mixture, key="k", source="source", tokens="n_tokens").withColumnsRenamed(
        {"k": key, "source": source}
    )


def remixed(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source", max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """``docs``, all columns and no others, each row as often as the mixture takes it. A source
    without any token has no weight; its rows come once."""
    # Under names of their own, as docs may have columns that are called like those in between.
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    rows = docs.toDF(*names).withColumn("tokens", token_count(text_or_empty(at[text])))
    sizes = source_sizes(rows, at[source], "tokens")
    mixture = temper(sizes, max_repeats=max_repeats)
    taken = mixed(rows, sizes, mixture, key=at[key], source=at[source], tokens="tokens")
    # Only rows without a token can be of such a source. Dealt as the plan in ``mixed`` is.
    weighted = sizes.repartition("tokens").select(F.col("source").alias("s_source"))
    blank = rows.where(~text_or_empty(at[text]).rlike(r"\S"))
    once = blank.join(weighted, blank[at[source]].eqNullSafe(weighted["s_source"]), "left_anti")
    return taken.select(*names).unionByName(once.select(*names)).toDF(*docs.columns)
