import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from zonewright.llm import neardup
from zonewright.llm.neardup import near_duplicates, shingles, without_near_duplicates

SCHEMA = "doc_id long, text string, comp long, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows):
    sets = [(i, plain_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            common = len(a & b)
            if a and b and 100 * common >= 75 * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def variants(seed, families, size, length=60, edits=4):
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(500)}" for _ in range(length)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                words[rng.randrange(length)] = f"v{rng.randrange(10_000)}"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_are_the_brute_force_ones(spark):
    rows = variants(1, 12, 9) + [(500 + i, f"lone text {i} " * 7) for i in range(20)]
    got = sorted(tuple(r) for r in near_duplicates(table(spark, rows)).collect())
    assert got == brute(rows)
    assert 20 < sum(r[3] for r in got) < len(rows)


def test_one_large_loose_family(spark, monkeypatch):
    # Copies that are linked through others only; one centre a bucket and no round to spare.
    monkeypatch.setattr(neardup, "STARS", 1)
    rows = variants(2, 1, 150, length=80, edits=7)
    assert sorted(tuple(r) for r in near_duplicates(table(spark, rows)).collect()) == brute(rows)


def test_short_and_odd_texts(spark):
    rows = [
        (9, "One two"), (3, "one TWO"), (4, "two one"), (5, None), (6, ""), (7, " \t\n"), (8, "É x"), (10, "é x"),
        (11, "a b c d e"), (12, "A b\tc\nd  e"), (13, "a b c d e f"), (14, "w " * 20_000), (15, "W " * 30_000), (16, "a b"), (17, "a b"),
    ]
    assert sorted(tuple(r) for r in near_duplicates(table(spark, rows)).collect()) == brute(rows)


def test_repeated_and_null_keys(spark):
    a, b = "first text of some words here", "second text with other words altogether"
    rows = [(2, a), (1, b), (1, a), (None, a), (5, b), (5, b)]
    got = sorted((tuple(r) for r in near_duplicates(table(spark, rows)).collect()), key=repr)
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (5, 1, False), (5, 1, False), (None, None, True)]


def test_texts_of_one_key_are_told_apart(spark):
    # Each of the two texts of key 7 has a partner; they are of one size, and one is there twice.
    rows = variants(5, 2, 3, edits=2)
    a, b = rows[0][1], next(t for _, t in rows if not set(t.split()) & set(rows[0][1].split()) or len(set(t.split()) & set(rows[0][1].split())) < 20)
    docs = [(i + 100, t) for i, t in rows if t not in (a, b)] + [(7, a), (7, b), (7, b)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(table(spark, docs)).collect()}
    linked = {i for i, t in docs[:-3] if any(brute([(1, t), (2, own)])[1][2] == 1 for own in (a, b))}
    assert linked and all(got[i] == 7 for i in linked) and got[7] == 7


def test_a_shared_passage_makes_no_pairs(spark):
    passage = " ".join(f"p{i}" for i in range(60))

    def near(n):
        rng = random.Random(n)
        texts = [" ".join([passage, *(f"w{rng.randrange(10**9)}" for _ in range(40))]) for _ in range(n)]
        docs = table(spark, list(enumerate(texts)))
        rows = neardup.signed(docs, "text", "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
        nodes = rows.select(F.col("doc_id").alias("id"), "same", "halves")
        sets = neardup._sets(docs, nodes.select("id"), nodes.select("id"), "text", "doc_id", docs.schema["doc_id"].dataType)
        return neardup.rare_first(sets, nodes).count()

    assert near(200) == near(400) == 0


def test_the_threshold_is_met_exactly(spark):
    words = [f"w{i}" for i in range(40)]
    # 36 shingles each; 6 and 5 others at the end: 30 of 42 and 31 of 41 are common, 75.6 % and 71.4 %.
    rows = [(1, " ".join(words)), (2, " ".join(words[:35] + [f"x{i}" for i in range(5)])), (3, " ".join(words[:34] + [f"y{i}" for i in range(6)]))]
    assert sorted(tuple(r) for r in near_duplicates(table(spark, rows)).collect()) == brute(rows)


def test_no_documents(spark):
    assert near_duplicates(table(spark, [])).count() == 0


def test_the_stage_keeps_one_of_each_group(spark):
    rows = variants(3, 6, 5) + [(1000, None), (1001, ""), (None, "a b"), (2000, "same key"), (2000, "same key")]
    docs = table(spark, rows)
    out = without_near_duplicates(docs)
    assert out.schema == docs.schema
    kept = [r["doc_id"] for r in out.collect()]
    want = [i for i, _, _, k in brute([(i, t) for i, t in rows[:-3]] + [(2000, "same key")]) if k] + [None]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_equal_hashes_are_as_frequent_as_the_similarity():
    import numpy as np

    rng = np.random.default_rng(5)
    hits = total = 0
    for _ in range(60):
        common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a = np.concatenate((common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)))
        b = np.concatenate((common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)))
        hits += (neardup.signature(a) == neardup.signature(b)).sum()
        total += neardup.COLLECTIONS * neardup.HASHES
    assert abs(hits / total - 0.75) < 0.02


@pytest.mark.parametrize("text", ["a b c d e f", "A B C D E F", "a  b\tc\nd e f"])
def test_shingles_know_words_only(text):
    assert shingles(text).tolist() == shingles("a b c d e f").tolist()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = defaultdict(set)
    for r in neardup.components(links).collect():
        got[r["comp"]].add(r["id"])
    assert got == {0: set(range(61)), 100: {100, 101}}


def test_what_is_left_is_met_once(spark, monkeypatch):
    """Nodes that share many groups make one row, and no linked ones are missed, whatever a row takes along."""
    rng = random.Random(5)
    passages = [[f"p{k}w{i}" for i in range(12)] for k in range(4)]
    texts = {}
    for i in range(60):
        words = [w for p in passages if rng.random() < 0.7 for w in p] + [f"own{i}x{j}" for j in range(rng.randrange(12))]
        texts[i] = " ".join(words) or "none"
    # Two texts under one id.
    rows = [*texts.items(), (3, " ".join(passages[0] + passages[1])), (7, " ".join(passages[1] + passages[2] + ["z"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = neardup.signed(docs, "text", "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    nodes = signed.groupBy("same").agg(F.min("doc_id").alias("id"), F.first("halves").alias("halves"))
    sets = neardup._sets(docs, nodes.select("id"), nodes.select("id"), "text", "doc_id", docs.schema["doc_id"].dataType)
    near = neardup.rare_first(sets, nodes).localCheckpoint()
    open_ = neardup.rare_groups(near).withColumn("comp", F.col("id"))
    held = [(r["id"], r["n"], frozenset(r["set"])) for r in sets.join(near.select("id", "same"), ["id", "same"]).distinct().collect()]
    linked = {
        (min(a, b), max(a, b))
        for a, n, x in held
        for b, m, y in held
        if a != b and 100 * len(x & y) >= neardup.PERCENT * len(x | y)
    }
    ids = [i for i, _, _ in held]
    once = {i for i in ids if ids.count(i) == 1}
    for most in (64, 3, 0):
        monkeypatch.setattr(neardup, "RARE_HELD", most)
        pairs = [(r["a"], r["b"]) for r in neardup.pairs_left(open_, near).collect()]
        assert linked and linked <= set(pairs)
        if most == 64:
            plain = [p for p in pairs if set(p) <= once]
            assert len(plain) == len(set(plain))
