from collections import Counter, defaultdict
from zlib import crc32

import numpy as np

from zonewright.llm.sharding import place_vectors, shard_documents

SCHEMA = "doc_id long, text string, shard string, unit int"


def rows_of(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in pairs], SCHEMA)


def check(rows, pairs, shards=16):
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in pairs)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_sizes_and_digests(spark):
    pairs = [(1, "abc"), (2, None), (3, ""), (4, "é"), (5, "abc"), (5, "abc"), (None, "z")]
    rows = shard_documents(rows_of(spark, pairs)).collect()
    check(rows, pairs)
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert got == Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in pairs)


def test_shards_are_near_equal_and_groups_stay_together(spark):
    rng = np.random.default_rng(1)
    pairs = [(i, "w " * int(rng.integers(1, 60)) + str(i)) for i in range(4000)]
    pairs += [(4000 + i, f"copy of one {i % 40}") for i in range(400)]
    rows = shard_documents(rows_of(spark, pairs)).collect()
    check(rows, pairs)
    load = defaultdict(lambda: np.zeros(2))
    for r in rows:
        load[r["shard"]] += (r["size"], 1)
    loads = np.stack(list(load.values()))
    assert len(loads) == 16
    assert np.ptp(loads[:, 0]) <= 200
    assert np.ptp(loads[:, 1]) <= 0.25 * loads[:, 1].mean()
    shards_of = defaultdict(set)
    for r in rows:
        shards_of[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(len(s) == 1 for s in shards_of.values())


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    pairs = [(i, "the one copy") for i in range(2000)] + [(2000 + i, f"text number {i} " * 3) for i in range(4000)]
    rows = shard_documents(rows_of(spark, pairs)).collect()
    check(rows, pairs)
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    assert max(size.values()) - min(size.values()) <= 0.01 * max(size.values())


def test_dot_product_takes_the_emptiest_shard():
    placed = place_vectors(np.array([[10.0, 1.0], [9.0, 1.0], [8.0, 1.0], [1.0, 1.0]]), 3, rounds=0)
    assert sorted(placed.shard[:3]) == [0, 1, 2]
    assert placed.shard[3] == placed.shard[2]


def test_no_rows(spark):
    assert shard_documents(rows_of(spark, [])).count() == 0
