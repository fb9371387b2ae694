from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewright.functions.embedding import FeatureHashing
from zonewright.operators import vectors as operators
from zonewright.operators.vectors import (
    changed_items,
    embed_texts,
    top_k,
    top_k_of,
)


def vectors(spark, data, id_type="long"):
    return spark.createDataFrame(data, f"id {id_type}, embedding array<float>")


def brute(data, query, k):
    def cosine(v):
        a, b = np.asarray(v, float), np.asarray(query, float)
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    scored = [
        (i, cosine(v)) for i, v in data if v is not None and len(v) == len(query) and any(v)
    ]
    return sorted(scored, key=lambda s: (-round(s[1], 6), s[0]))[:k]


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    data += [(1000 + i, data[5][1]) for i in range(40)]  # copies: ties are broken by id
    queries = [(q, data[q][1]) for q in (5, 17, 44)]
    for parts, batch in ((1, "7"), (6, "10000")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = top_k(vectors(spark, data).repartition(parts), queries, 10, score_digits=6)
            found = got.orderBy("query_id", "rank").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        for q, v in queries:
            mine = [(r["id"], r["score"]) for r in found if r["query_id"] == q]
            want = brute(data, v, 10)
            assert [i for i, _ in mine] == [i for i, _ in want]
            assert np.allclose([s for _, s in mine], [s for _, s in want], atol=1e-6)


def test_top_k_edge_vectors(spark):
    data = [
        ("b", [1.0, 0.0]),
        ("a", [2.0, 0.0]),
        ("z", [0.0, 0.0]),
        ("n", None),
        ("s", [1.0]),
        ("h", [1.0, None]),
        ("o", [-1.0, 0.0]),
    ]
    got = top_k(vectors(spark, data, "string"), [("q", [1.0, 0.0])], 10).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in got] == [("a", 1.0), ("b", 1.0), ("o", -1.0)]
    none = top_k(vectors(spark, data, "string"), [("q", [0.0, 0.0])], 3)
    assert none.count() == 0
    assert top_k(vectors(spark, data, "string"), [], 3).count() == 0
    odd = [("null", None), ("empty", []), ("hole", [1.0, None]), ("short", [2.0]), ("q", [1.0, 0.0])]
    found = top_k(vectors(spark, data, "string"), odd, 2).collect()
    assert sorted((r["query_id"], r["id"]) for r in found) == [("q", "a"), ("q", "b"), ("short", "s")]


@pytest.mark.parametrize("k", [3, 1500])
def test_tasks_pass_few_rows_on(spark, k):
    df = vectors(spark, [(i, [1.0, float(i % 9)]) for i in range(2500)]).repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = top_k(df, [(0, [1.0, 0.0])], k)
        assert [r["rank"] for r in got.orderBy("rank").collect()] == list(range(1, k + 1))
        passed = top_k(df, [(0, [1.0, 0.0])], k)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in passed
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_queries_beyond_one_block(spark):
    data = [(i, [float(i % 7) + 0.5, 1.0]) for i in range(60)]
    df = vectors(spark, data)
    got = top_k_of(df, df, 2, query_rows=7).orderBy("query_id", "rank").collect()
    want = top_k(df, data, 2).orderBy("query_id", "rank").collect()
    assert len(got) == 120 and got == want


def test_many_queries_scan_the_vectors_once(spark, tmp_path):
    rng = np.random.default_rng(7)
    data = [(i, rng.normal(size=6).round(2).tolist()) for i in range(700)]
    asked = [(10_000 + i, rng.normal(size=6).round(2).tolist()) for i in range(2500)]
    vectors(spark, data).write.parquet(str(tmp_path / "vectors"))
    vectors(spark, asked).write.parquet(str(tmp_path / "asked"))
    stored, queries = (spark.read.parquet(str(tmp_path / n)) for n in ("vectors", "asked"))
    for parts in (None, 3):
        df = top_k_of(stored, queries, 3, score_digits=6, vector_parts=parts)
        got = df.orderBy("query_id", "rank").collect()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2 and "Join" not in plan
        matrix, block = (np.asarray([v for _, v in x]) for x in (data, asked))
        scores = (matrix @ block.T) / np.linalg.norm(matrix, axis=1)[:, None] / np.linalg.norm(block, axis=1)
        assert [(r["query_id"], r["rank"]) for r in got] == [(q, n) for q, _ in asked for n in (1, 2, 3)]
        best = np.sort(scores.round(6), axis=0)[::-1][:3].T.ravel()
        assert np.allclose([r["score"] for r in got], best, atol=1e-6)


@pytest.mark.parametrize("many", [1, 4])
def test_vectors_are_not_shuffled_for_every_block(spark, monkeypatch, many):
    """Rows of the grid grow with the tables, however few queries are matched at a time."""
    n, made = 200 * many, []
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = operators._grid
    monkeypatch.setattr(operators, "_grid", lambda *a: made.append(grid(*a)) or made[0])
    df = vectors(spark, [(i, [float(i), 1.0, 2.0]) for i in range(n)])
    asked = df.filter("id % 5 = 0")
    assert top_k_of(df, asked, 2, query_rows=2).count() == 2 * n // 5
    # Bands of all vectors and parts of all queries: 2 x sqrt(tasks / 5) x n at best.
    assert made[0].count() <= 3 * (tasks / 5) ** 0.5 * n
    # With a bound on what a cell holds there are as many bands as that asks for.
    monkeypatch.setattr(operators, "CELL_BYTES", 24 * 4)
    bands = []
    monkeypatch.setattr(operators, "_grid", lambda *a: bands.append(a[2]) or grid(*a))
    got = top_k_of(df, asked, 2, query_rows=2, score_digits=6).collect()
    assert bands == [n // 5 // 4]
    want = top_k(df, [(r["id"], r["embedding"]) for r in asked.collect()], 2, score_digits=6).collect()
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got) == sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in want)


def test_odd_queries_in_the_grid(spark):
    data = [(i, [float(i), 1.0]) for i in range(9)] + [(20, [1.0, 2.0, 3.0]), (21, None), (22, [0.0, 0.0])]
    asked = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 2.0, 3.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]), (None, [0.0, 1.0]), (7, [1.0])]
    df, queries = vectors(spark, data), vectors(spark, asked)
    for rows_at_once in (2, 100):
        got = top_k_of(df, queries, 2, query_rows=rows_at_once).collect()
        assert sorted(((r["query_id"], r["rank"], r["id"]) for r in got), key=repr) == [(1, 1, 8), (1, 2, 7), (2, 1, 20), (None, 1, 0), (None, 2, 1)]
        assert top_k_of(df, queries.limit(0), 2, query_rows=rows_at_once).count() == 0
        assert top_k_of(df.limit(0), queries, 2, query_rows=rows_at_once).count() == 0


def test_embedding_runs_in_batches_over_whole_texts(spark):
    texts = [(i, f"word{i} " * 50 + "tail") for i in range(250)] + [(999, None), (1000, "")]

    def count(batch):
        return [[float(len(batch)), float(len(t))] for t in batch]

    got = embed_texts(
        spark.createDataFrame(texts, "i long, t string").repartition(2), "i", "t", count
    ).collect()
    assert len(got) == 252
    assert max(r["embedding"][0] for r in got) <= 100
    assert {r["i"]: r["embedding"][1] for r in got} == {i: len(t or "") for i, t in texts}


def plain_hashing(text, size, seed=0):
    out = np.zeros(size)
    for word in text.split(" "):
        if word:
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            code = crc32(f"{seed}:{word}".encode())
            out[(code >> 1) % size] += 1 if code & 1 else -1
    return out / (np.linalg.norm(out) or 1)


@pytest.mark.parametrize("size, seed", [(1, 0), (7, 3), (16, 0), (64, 1)])
def test_feature_hashing(spark, size, seed):
    texts = ["The film, THE end", "", "   ", "a b a\nb c", "Élan élan naïve", "w " * 3000, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r["i"]: r["embedding"] for r in embed_texts(df, "i", "t", FeatureHashing(size, seed)).collect()}
    for i, t in enumerate(texts):
        assert np.allclose(got[i], plain_hashing(t or "", size, seed), atol=1e-6)
    assert embed_texts(df.limit(0), "i", "t", FeatureHashing(size)).count() == 0


def test_hashing_needs_no_python_worker(spark, final_plan):
    df = spark.createDataFrame([(1, "a b")], "i long, t string")
    assert "Python" not in final_plan(embed_texts(df, "i", "t", FeatureHashing(8)))


def test_the_numbers_of_a_text_are_divided_once_and_not_for_each_slot(spark):
    df = spark.createDataFrame([(1, "a b")], "i long, t string")
    plan = embed_texts(df, "i", "t", FeatureHashing(8))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries(") == 1 and "element_at(map_from_entries(" not in plan
    assert "element_at" in plan.splitlines()[0] and "length" not in plan.splitlines()[0]


def test_a_model_gets_texts_only(spark):
    df = spark.createDataFrame([(2**60 + 1, "a b", {"x": "y"}), (None, "c", None)], "i long, t string, m map<string,string>")
    got = embed_texts(df, "i", "t", lambda texts: [[float(len(t))] for t in texts])
    assert sorted((r["embedding"], r["i"] or 0) for r in got.collect()) == [([1.0], 0), ([3.0], 2**60 + 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "run(coalesce(t#" in plan and got.columns == ["i", "embedding"]


def test_changed_items(spark, rows):
    items = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "id int, h string")
    known = spark.createDataFrame([(1, "h1"), (2, "old")], "id int, h string")
    assert rows(changed_items(items, known, "id", "h").select("id")) == [(2,), (3,)]


def test_worker_needs_no_package(spark):
    doubled = embed_texts(
        spark.createDataFrame([(1, "x")], "i long, t string"), "i", "t", lambda texts: [[1.0] * 4 for _ in texts]
    ).select(F.size("embedding"))
    assert doubled.first()[0] == 4
