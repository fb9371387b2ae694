"""Text to vectors by signed feature hashing: no model and no Python worker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """What spaces part, with A to Z in lower case."""
    return F.filter(F.split(F.translate(text, _UPPER, _UPPER.lower()), " "), lambda w: w != "")


@dataclass(frozen=True)
class FeatureHashing:
    """Vectors of ``size`` signed word counts, scaled to length one; zeros without words. The crc32 of a
    word, after ``seed`` and a colon, gives its slot and, by its last bit, its sign."""

    size: int = 64
    seed: int = 0

    def vectors(self, df: DataFrame, key: str, text: str, out: str = "embedding") -> DataFrame:
        """``key, out`` for every key of ``df``. Words are counted by key and slot in the tasks that
        read them, so that at most ``size`` small rows a key and task are shuffled. Rows that repeat
        a key are one text; a null text is an empty one."""
        words = df.select(F.col(key).alias("k"), F.explode_outer(words_of(F.col(text))).alias("w"))
        code = F.crc32(F.encode(F.concat(F.lit(f"{self.seed}:"), "w"), "UTF-8"))
        counted = (
            words.select("k", code.alias("c"))
            .groupBy("k", (F.shiftright("c", 1) % self.size).cast("int").alias("slot"))
            .agg(F.sum((F.col("c") % 2) * 2 - 1).cast("double").alias("n"))
        )
        # A key has ``size`` slots at most, and one without a number if it has no words.
        found = counted.groupBy("k").agg(
            F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("length"),
            F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "n"))).alias("slots"),
        )
        # An expression that is named once is moved to where it is named, here into what runs once a slot;
        # ``weights`` is named twice, so that a row's numbers are divided and put into a map once.
        weight = lambda e: F.when(F.col("length") > 0, e["n"] / F.col("length")).otherwise(F.lit(0.0))
        weights = F.map_from_entries(F.transform("slots", lambda e: F.struct(e["slot"], weight(e))))
        value = lambda s: F.coalesce(F.try_element_at("weights", s), F.lit(0.0))
        vector = F.when(
            F.size("weights") > 0, F.transform(F.sequence(F.lit(0), F.lit(self.size - 1)), value)
        ).otherwise(F.array_repeat(F.lit(0.0), self.size))
        return found.select("k", weights.alias("weights")).select(F.col("k").alias(key), vector.cast("array<float>").alias(out))
