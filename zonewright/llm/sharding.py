"""Shards by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from zonewright.llm.common import stage, text_or_empty, utf8_bytes, utf8_crc32

SHARDS = 16
# Share of the whole from which a group of equal texts is placed by itself: 1 / UNITS of
# the bytes, tokens or rows. So at most UNITS groups per measure reach the driver.
UNITS = 4096
# A group over this share of one shard is dealt over several shards.
WHOLE_UP_TO = 0.25


@dataclass
class Placement:
    shard: np.ndarray
    load: np.ndarray


def place_vectors(items: np.ndarray, shards: int, rounds: int = 4000) -> Placement:
    """Put each item (a row of ``items``, one column per measure) into the shard where the
    dot product of the item and the shard's residual capacity is highest; large items go
    first, ties to the smaller shard number.

    The dot product may trade one measure for another, so single items are then moved or
    exchanged between the fullest and the emptiest shard of the first measure for as long
    as that narrows it (``rounds`` at most, as every round looks at all items of two shards).
    """
    total = items.sum(axis=0)
    share = items / np.where(total > 0, total, 1)
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    shard = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.max(axis=1))):
        best = int(np.argmax(residual @ share[i]))
        shard[i] = best
        residual[best] -= share[i]
    size = items[:, 0]
    load = np.zeros((shards, items.shape[1]))
    np.add.at(load, shard, items)
    for _ in range(rounds):
        high, low = int(load[:, 0].argmax()), int(load[:, 0].argmin())
        half = (load[high, 0] - load[low, 0]) / 2
        ours = np.flatnonzero(shard == high)
        theirs = np.flatnonzero(shard == low)
        if half <= 0.5 or not len(ours):
            break
        # The change wanted is `half`; a move is an exchange with an item of size nought.
        others = np.concatenate(([0], np.sort(size[theirs])))
        order = np.concatenate(([-1], theirs[np.argsort(size[theirs], kind="stable")]))
        at = np.searchsorted(others, size[ours] - half).clip(0, len(others) - 1)
        before = (at - 1).clip(0)
        gain_at = np.abs(size[ours] - others[at] - half)
        gain_before = np.abs(size[ours] - others[before] - half)
        pick = np.where(gain_before < gain_at, before, at)
        gain = np.minimum(gain_before, gain_at)
        i = int(gain.argmin())
        if gain[i] >= half:
            break
        a, b = int(ours[i]), int(order[pick[i]])
        shard[a] = low
        load[high] -= items[a]
        load[low] += items[a]
        if b >= 0:
            shard[b] = high
            load[low] -= items[b]
            load[high] += items[b]
    return Placement(shard, load)


def shard_documents(
    docs: DataFrame, *, shards: int = SHARDS, units: int = UNITS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Every row of ``docs`` with its shard and its place there.

    Returns ``key, size, text_crc32, n_tokens, law, shard, slot, grown_shard``. The law is
    ``bytes``: sizes (UTF-8 bytes and 1) are near equal, tokens (words) and rows as equal as
    that leaves them. Rows of one text stay together unless they are over a quarter of a
    shard; then they are dealt out by key. Light groups are gathered into ``units`` cells by
    hash, so that the driver places a number of items that does not depend on the input:
    at most ``units`` cells, ``units`` heavy groups for each of the three measures, and
    the pieces of those. Slots count the rows of a shard from 0 without gaps, by unit, then key.

    A null text counts as no bytes and is a text of its own; a null key is dealt like any
    other value, repeated rows are separate rows; no rows give no rows. Other columns of
    ``docs`` are not looked at.
    """
    body = text_or_empty(text)
    rows = stage(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.when(F.col(text).isNull(), F.lit(0)).otherwise(utf8_bytes(body)) + 1).cast("long").alias("size"),
            utf8_crc32(body).cast("long").alias("text_crc32"),
            F.regexp_count(body, F.lit(r"\S+")).cast("long").alias("n_tokens"),
            F.xxhash64(F.col(text).isNull(), body).alias("g"),
        ),
        "shards",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    measures = ("bytes", "tokens", "rows")
    # Sizes differ within a key only where two texts share a hash, which the crc tells apart.
    of_group = ["g", "text_crc32", "size"]
    group = rows.groupBy(*of_group).agg(
        F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")
    )
    heavy_if = F.lit(False)
    for m in measures:
        heavy_if = heavy_if | (F.col(m) * units > F.lit(total[m] or 0))
    heavy = sorted(tuple(r) for r in group.where(heavy_if).collect())

    # Unit numbers: the cells, then one or more units for every heavy group.
    spark, first, known, item_of = docs.sparkSession, units, [], list(range(units))
    items = units
    for g, crc, size, *sizes in heavy:
        share = max(s / total[m] for s, m in zip(sizes, measures, strict=True) if total[m])
        subs = max(1, int(np.ceil(share * units)))
        known.append((g, crc, size, first, subs))
        if share * shards > WHOLE_UP_TO:
            item_of += range(items, items + subs)
            items += subs
        else:
            item_of += [items] * subs
            items += 1
        first += subs
    schema = StructType(
        [StructField("g", LongType()), StructField("text_crc32", LongType()), StructField("size", LongType()),
         StructField("first", LongType()), StructField("subs", LongType())]
    )
    cell = F.pmod(F.xxhash64(F.lit("cell"), "g", "text_crc32"), F.lit(units))
    piece = F.pmod(F.xxhash64(F.lit("piece"), "doc_id"), F.col("subs"))
    in_units = rows.join(
        F.broadcast(spark.createDataFrame(known, schema)), of_group, "left"
    ).select(
        "doc_id", "size", "text_crc32", "n_tokens",
        F.coalesce(F.col("first") + piece, cell).cast("int").alias("unit"),
    )
    weighed = {r["unit"]: r for r in in_units.groupBy("unit").agg(*sums).collect()}

    loads = np.zeros((items, 3))
    for u, r in weighed.items():
        loads[item_of[u]] += [r[m] for m in measures]
    used = np.flatnonzero(loads[:, 2])
    shard_of = np.zeros(items, dtype=np.int64)
    shard_of[used] = place_vectors(loads[used], shards).shard
    next_slot, places = [0] * shards, []
    for u in sorted(weighed):
        s = int(shard_of[item_of[u]])
        places.append((u, s, next_slot[s]))
        next_slot[s] += weighed[u]["rows"]
    schema = StructType(
        [StructField("unit", IntegerType()), StructField("shard", IntegerType()), StructField("before", LongType())]
    )
    within = Window.partitionBy("unit").orderBy("doc_id", "text_crc32", "size")
    return (
        in_units.withColumn("at", F.row_number().over(within))
        .join(F.broadcast(spark.createDataFrame(places, schema)), "unit")
        .select(
            F.col("doc_id").alias(key), "size", "text_crc32", "n_tokens",
            F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("at") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
