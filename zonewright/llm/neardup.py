"""Near-duplicate documents: MinHash with tensored banding, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonewright.llm.common import small_batches, stage

WORDS = 5
# Linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
# Small collections of hashes, and the hashes in each. A table's key joins two collections, so
# that C collections make C * (C - 1) / 2 tables: 28 collections of 3 give 378 tables of 6 hashes
# from 84 hashes. A pair at the least similarity misses all tables with probability 5e-6.
COLLECTIONS = 28
HASHES = 3
# Rounds at most in which a document is compared with one centre only, before all that is left; a round
# that finds no link is the last.
STARS = 4
# Of a node's rare shingles, those it takes along when all that is left is compared.
RARE_HELD = 64
SEED = 11
SHINGLES_AT_ONCE = 20_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


_HASH = WordHashes()
_RNG = np.random.default_rng(SEED)
_PLACES = _RNG.integers(1, 1 << 63, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RNG.integers(1, 1 << 31, size=COLLECTIONS * HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _RNG.integers(0, 1 << 32, size=COLLECTIONS * HASHES, dtype=np.uint64).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words; of all words, if they are fewer.
    Words are what ASCII white space parts, with A to Z in lower case."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WORDS, len(h))
    runs = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        runs += h[i : len(h) - width + 1 + i] * _PLACES[i]
    return np.unique(_mixed(runs))


def signature(set_: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    low = (set_ >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTORS), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(low), SHINGLES_AT_ONCE):
        part = low[at : at + SHINGLES_AT_ONCE]
        for i, (a, b) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
            least[i] = min(least[i], (part * a + b).min())
    return least


def half_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit value for each collection's hashes."""
    parts = least.reshape(COLLECTIONS, HASHES).astype(np.uint64)
    out = np.arange(1, COLLECTIONS + 1, dtype=np.uint64)
    for i in range(HASHES):
        out = _mixed(out * _PLACES[i] + parts[:, i])
    return out.view(np.int64)


def fingerprint(set_: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(set_.tobytes())


def signed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``doc_id, n_shingles, same, halves``: ``same`` tells equal sets; no set, nulls."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, same, halves = [], [], []
            for text_ in batch["text"]:
                set_ = shingles(text_)
                sizes.append(len(set_))
                if len(set_):
                    same.append(fingerprint(set_))
                    halves.append(half_keys(signature(set_)))
                else:
                    same.append(None)
                    halves.append(None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": np.asarray(sizes, dtype="int64"), "same": same, "halves": halves})

    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(
        sign, "doc_id string, n_shingles long, same binary, halves array<long>"
    )


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by the keys of the join to come, but by another hash of them: the join then has
    plain exchanges on both sides, so that a key that many rows have can be split."""
    return df.repartition(F.xxhash64(F.lit("apart"), *keys))


def table_keys(nodes: DataFrame) -> DataFrame:
    """``key, id``: in which tables' buckets a node is not alone, as far as one half tells. A half
    key that only one node has can be in no shared bucket, so it makes no keys at all."""
    halves = nodes.select("id", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("slot", "half").agg(F.count("*").alias("n")).where("n > 1").select("slot", "half")
    kept = halves.join(apart(shared, "slot", "half"), ["slot", "half"])
    lists = kept.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("slot", "half"))).alias("h")).where(F.size("h") > 1)
    first = F.explode(F.sequence(F.lit(1), F.size("h") - 1))
    return (
        lists.withColumn("i", first)
        .select("id", F.col("h")[F.col("i") - 1].alias("a"), F.explode(F.slice("h", F.col("i") + 1, F.size("h"))).alias("b"))
        .select(F.xxhash64("a.slot", "a.half", "b.slot", "b.half").alias("key"), "id")
    )


def rare_first(sets: DataFrame, halves: DataFrame) -> DataFrame:
    """``id, same, n, halves, shared, alone, take`` of the nodes that can have a partner: their shingles that other
    nodes have too, the rarest first, how many only they have, and how many of ``shared`` a partner
    must hit: of two linked sets, neither lacks more than a quarter of its shingles in the other."""
    held = sets.select("id", "same", "n", F.explode("set").alias("s"))
    common = held.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # A set, as rows that repeat a key and a text would give their shingles again.
    ranked = F.sort_array(F.collect_set(F.struct("df", "s")))
    lists = held.join(apart(common, "s"), "s").groupBy("id", "same", "n").agg(F.transform(ranked, lambda x: x["s"]).alias("shared"))
    needed = F.floor((F.col("n") * PERCENT + 99) / 100)
    lists = lists.withColumn("alone", F.col("n") - F.size("shared")).withColumn("take", (F.col("n") - needed + 1 - F.col("alone")).cast("int"))
    return lists.where("take > 0").join(halves, ["id", "same"])


def rare_groups(nodes: DataFrame) -> DataFrame:
    """``x, y, id, n, pos``: groups of nodes that share a rare shingle, ``pos`` being its place among a
    node's shingles, the rarest first. Shingles that the very same nodes share make one group."""
    rare = nodes.select("id", "same", "n", "alone", F.posexplode(F.slice("shared", 1, F.col("take"))).alias("i", "s"))
    rare = rare.select("s", "id", "same", "n", (F.col("alone") + F.col("i")).alias("pos"))
    same = rare.groupBy("s").agg(
        F.bit_xor(F.xxhash64("id", "same")).alias("x"), F.bit_xor(F.xxhash64(F.lit(SEED), "id", "same")).alias("y"), F.count("*").alias("m")
    ).where("m > 1")
    placed = rare.join(apart(same.select("s", "x", "y"), "s"), "s")
    return placed.groupBy("x", "y", "id", "same", "n").agg(F.min("pos").alias("pos")).drop("same")


def can_be_linked(n_a: str, pos_a: str, n_b: str, pos_b: str) -> Column:
    """Whether sizes and what comes after the first shared shingle leave room for enough shared ones."""
    a, b = F.col(n_a), F.col(n_b)
    left = F.least(a - F.col(pos_a), b - F.col(pos_b))
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT) & (left * (100 + PERCENT) >= (a + b) * PERCENT)


def enough_rare(n_a: str, n_b: str, rare: Column) -> Column:
    """Whether so many shared rare shingles leave room for enough shared ones: of the node whose rare
    ones end first, all others, three quarters less one, may be shared as well."""
    wanted = F.ceil((F.col(n_a) + F.col(n_b)) * PERCENT / (100 + PERCENT))
    others = F.floor((F.greatest(n_a, n_b) * PERCENT + 99) / 100) - 1
    return rare + others >= wanted


def pairs_left(open_: DataFrame, near: DataFrame) -> DataFrame:
    """``a, b``: nodes of different components that are in one group and can be linked, met once: in the first
    group both are in. A row takes the node's first ``RARE_HELD`` rare shingles along: what two nodes share of
    them before this group's tells that they meet elsewhere, and lists that are whole tell how many they share.
    Longer lists may meet more than once, but never miss each other. So do ids with several texts."""
    held = near.groupBy("id").agg(
        F.count("*").alias("texts"), F.first("alone").alias("alone"), F.first(F.col("take") <= RARE_HELD).alias("whole"),
        F.first(F.slice("shared", 1, F.least("take", F.lit(RARE_HELD)))).alias("held"),
    ).where("texts = 1")
    # How many of the held ones come before the group.
    rows = open_.join(apart(held, "id"), "id", "left").select("x", "y", "id", "n", "pos", "comp", "held", "whole", (F.col("pos") - F.col("alone")).cast("int").alias("i"))
    other = rows.toDF("x", "y", *(f"{c}_r" for c in rows.columns[2:]))
    elsewhere = F.arrays_overlap(F.slice("held", F.lit(1), F.col("i")), F.slice("held_r", F.lit(1), F.col("i_r")))
    enough = enough_rare("n", "n_r", F.size(F.array_intersect("held", "held_r")))
    met = rows.join(other, ["x", "y"]).where(
        (F.col("comp") < F.col("comp_r")) & can_be_linked("n", "pos", "n_r", "pos_r")
        & ~F.coalesce(elsewhere, F.lit(False)) & (~F.coalesce(F.col("whole") & F.col("whole_r"), F.lit(False)) | enough)
    )
    return met.select(*ordered(F.col("id"), F.col("id_r")))


def confirmed(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that share a table's bucket and are linked, which whole sets tell."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "halves", "shared")))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(F.size(F.array_intersect("halves_a", "halves_b")) > 1)
    # Shingles that only one node has are in no intersection.
    common = F.size(F.array_intersect("shared_a", "shared_b"))
    return both.withColumn("common", common).where(
        F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * PERCENT
    ).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``id, comp`` for every node of ``links`` (``a, b``): the smallest node it reaches. Labels
    spread over links and jump to their label's label, until nothing changes."""
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "dup-links")
    label = stage(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("comp")).withColumnRenamed("a", "id"), "dup-labels")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        spread = label.join(apart(near.withColumnRenamed("a", "id"), "id"), "id").select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        spread = stage(spread, "dup-labels")
        over = spread.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        jumped = stage(
            spread.join(over, "comp").select("id", "old", F.col("next").alias("comp")), "dup-labels"
        )
        changed = jumped.where("comp <> old").limit(1).count()
        label = jumped.select("id", "comp")
        if not changed:
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (``id, comp``) after ``links`` between nodes: only the components are joined up."""
    one = links.join(label.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a")
    two = one.join(label.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
    between = stage(two.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "dup-between")
    if between.isEmpty():
        return label
    anew = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("anew"))
    return stage(
        label.join(apart(anew, "comp"), "comp", "left").select("id", F.coalesce("anew", "comp").alias("comp")), "dup-comps"
    )


def ordered(x: Column, y: Column) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row of ``docs``.

    Rows with equal sets are one node, named by the smallest key. Nodes share a bucket if two
    of their collections of hashes agree (tensored banding). Nodes that share one are compared if
    they also share one of their rarest shingles and their sizes and the shingle's places leave
    room for a link; links are confirmed on whole sets. So documents that have a passage
    in common and little else make no pairs. In up to ``STARS`` rounds every node is compared with
    one centre, the one it shares most groups with, and links are joined up to components, so that
    a large group of copies costs a comparison or a few for each. Then all nodes of different
    components that are still in one group are compared, a pair once (``pairs_left``). ``component_id`` is the smallest key
    that links reach, ``kept`` whether it is the row's own.

    A null or empty text, or one of white space, has no shingles and is linked with nothing.
    Rows that repeat a key are one document: it is linked if one of its texts is. A null key
    is never linked, has no component and is kept. No rows give no rows. Other columns are not
    looked at.
    """
    kind = docs.schema[key].dataType
    rows = stage(signed(docs, text, key).withColumn("doc_id", F.col("doc_id").cast(kind)), "dup-signed")
    grouped = rows.where("same is not null and doc_id is not null").groupBy("same")
    nodes = stage(
        grouped.agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"), F.count("*").alias("copies")
        ),
        "dup-nodes",
    )
    keys = stage(table_keys(nodes).distinct(), "dup-keys")
    # Nodes that are in a bucket of two and more.
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    ids = stage(keys.join(apart(shared, "key"), "key").select("id").distinct(), "dup-members")
    sets = stage(_sets(docs, nodes.select("id"), ids, text, key, kind), "dup-sets")
    near = stage(rare_first(sets, nodes.select("id", "same", "halves")), "dup-near")
    groups = stage(rare_groups(near), "dup-groups")

    label = stage(groups.select("id").distinct().withColumn("comp", F.col("id")), "dup-comps")
    for n in range(STARS):
        open_ = _open_groups(groups, label)
        centre = F.min_by(F.struct("id", "n", "pos", "comp"), F.xxhash64(F.lit(n), "id"))
        centres = open_.groupBy("x", "y").agg(centre.alias("c")).select("x", "y", "c.id", "c.n", "c.pos", "c.comp").toDF("x", "y", "c", "n_c", "pos_c", "comp_c")
        stars = open_.join(apart(centres, "x", "y"), ["x", "y"]).where((F.col("comp") != F.col("comp_c")) & can_be_linked("n", "pos", "n_c", "pos_c"))
        best = stars.groupBy("id", "c").agg(F.count("*").alias("groups")).groupBy("id").agg(F.max(F.struct("groups", "c")).alias("best"))
        pairs = best.select(*ordered(F.col("id"), F.col("best.c"))).distinct()
        links = stage(confirmed(pairs, near), "dup-confirmed")
        if links.isEmpty():
            break
        label = merged(label, links)
        # A group that is over stays so: components only grow.
        groups = open_.drop("comp")
    rest = pairs_left(_open_groups(groups, label), near).distinct()
    label = merged(label, stage(confirmed(rest, near), "dup-confirmed"))

    # Only what differs from a row's own key is looked up.
    copies = nodes.where("copies > 1").select("same", F.col("id").alias("first"))
    joined = label.where("id <> comp").select(F.col("id").alias("node"), "comp")
    out = rows.select("doc_id", "n_shingles", "same").join(apart(copies, "same"), "same", "left")
    out = out.withColumn("node", F.coalesce("first", "doc_id")).join(apart(joined, "node"), "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "node"))
    return out.select(
        F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, text: str, key: str, kind) -> DataFrame:
    """``id, same, n, set`` of the nodes in ``ids``: their whole sets."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"], "same": [fingerprint(s) for s in sets],
                    "n": np.array([len(s) for s in sets], dtype="int64"), "set": [s.view(np.int64) for s in sets],
                }
            )

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).where("id is not null")
    return (
        rows.join(ids, "id", "left_semi").select(F.col("id").cast("string").alias("id"), "text")
        .mapInPandas(build, "id string, same binary, n long, set array<long>")
        .where("n > 0")
        .withColumn("id", F.col("id").cast(kind))
    )


def _open_groups(groups: DataFrame, label: DataFrame) -> DataFrame:
    """``groups`` with ``comp``, those that have nodes of two components and more."""
    placed = groups.join(label, "id").select("x", "y", "id", "n", "pos", "comp")
    open_ = placed.groupBy("x", "y").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("x", "y")
    return stage(placed.join(apart(open_, "x", "y"), ["x", "y"]), "dup-open")


def without_near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their component; rows with a null key
    stay. Of rows that repeat a key, the first by text, then by a hash of all columns, stays."""
    # Under names of their own, as docs may have columns that are called like those in between.
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_, body = (names[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*names)
    found = near_duplicates(rows, text=body, key=id_)
    counted = found.where(F.col(id_).isNotNull()).groupBy(F.col(id_).alias("id"))
    doubtful = stage(
        counted.agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1 or not kept"), "dup-gone"
    )
    once = rows.join(doubtful, rows[id_] == doubtful["id"], "left_anti")
    again = rows.join(doubtful.where("kept"), rows[id_] == doubtful["id"], "left_semi")
    first = Window.partitionBy(id_).orderBy(body, F.xxhash64(*names))
    again = again.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
    return once.unionByName(again).toDF(*docs.columns)
