import math

import numpy as np
import pytest

from zonewright.llm import neighbours
from zonewright.llm.neighbours import chi_square, chi_square_quantile, nearest_by_inner_product
from zonewright.llm.topk import exact_top_k
from zonewright.llm.vectors import best_of_rows

SCHEMA = "vec_id long, embedding array<float>, v string, score double"
ODD = [(1001, None), (1002, [1.0, None]), (1003, [float("nan"), 1.0]), (1004, [float("inf"), 0.0]), (None, [1.0, 1.0]), (1005, [])]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], SCHEMA)


def vectors(n, length=8, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, length))
    rows = [(i, (centres[i % 5] + 0.4 * rng.standard_normal(length)).astype("float32").tolist()) for i in range(n)]
    return rows + [(n + i, rows[7][1]) for i in range(copies)]


def brute(rows, k, every, value, take=lambda v: True):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and take(v):
            usable[i] = min(usable.get(i, v), v)
    out = []
    for q in sorted(usable):
        if q % every == 0:
            scored = [(-value(usable[q], v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def integer_product(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_exact_top_k_is_the_brute_force_one(spark, rows, lists):
    given = vectors(300, copies=40) + ODD + [(0, vectors(1)[0][1]), (400, [0.5] * 3), (450, [0.25] * 3), (500, [0.0] * 8)]
    got = exact_top_k(table(spark, given), lists=lists, every=50).orderBy("query_id", "rank")
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert [tuple(r) for r in got.collect()] == brute(given, 5, 50, integer_product)


def test_exact_top_k_works_through_blocks_of_queries(spark):
    given = vectors(200)
    got = exact_top_k(table(spark, given), every=3, query_block=20).orderBy("query_id", "rank")
    assert [tuple(r) for r in got.collect()] == brute(given, 5, 3, integer_product)


def test_large_components_stay_exact(spark):
    given = [(i, [float(2**20 + i), float(i % 7), -float(2**19)]) for i in range(40)]
    got = exact_top_k(table(spark, given), every=10).orderBy("query_id", "rank")
    assert [tuple(r) for r in got.collect()] == brute(given, 5, 10, integer_product)


def test_no_vectors_no_result(spark):
    assert exact_top_k(table(spark, [])).count() == 0
    assert exact_top_k(table(spark, ODD)).count() == 0
    assert nearest_by_inner_product(table(spark, ODD)).count() == 0
    assert nearest_by_inner_product(table(spark, [(20, [0.0, 0.0]), (40, [1.0, 0.0])])).count() == 0


def product(a, b):
    return sum(float(x) * float(y) for x, y in zip(a, b, strict=True))


def test_few_rows_are_all_found(spark):
    given = vectors(15) + ODD + [(20, vectors(1)[0][1])]
    got = [tuple(r) for r in nearest_by_inner_product(table(spark, given), every=20).orderBy("query_id", "rank").collect()]
    want = brute(given, 20, 20, product, any)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_recall_and_scores(spark, monkeypatch):
    # Small blocks and leaves, so that there is something to leave out.
    monkeypatch.setattr(neighbours, "BLOCK", 200)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    given = vectors(3000, length=24, seed=4, copies=300)
    given = [(i, [float(np.float32(x * (1 + i % 3))) for x in v]) for i, v in given]
    got = [tuple(r) for r in nearest_by_inner_product(table(spark, given)).collect()]
    want = brute(given, 20, 20, product, any)
    found = {(q, i): s for q, _, i, s in got}
    hits = [(q, i) for q, _, i, _ in want if (q, i) in found]
    assert len(got) == len(want) and len(hits) >= 0.95 * len(want)
    score = {(q, i): s for q, _, i, s in want}
    assert all(abs(found[h] - score[h]) < 1e-9 for h in hits)
    by = {}
    for q, rank, i, s in got:
        by.setdefault(q, []).append((rank, -s, i))
    for ranked in by.values():
        ranked.sort()
        assert [r[0] for r in ranked] == list(range(1, 21))
        assert [r[1:] for r in ranked] == sorted(r[1:] for r in ranked)


def test_chi_square_quantiles():
    for freedom, p, want in ((8, 0.95, 15.507), (8, 0.5, 7.344), (2, 0.95, 5.991), (4, 0.99, 13.277)):
        assert abs(chi_square_quantile(p, freedom) - want) < 1e-3
        assert abs(chi_square(want, freedom) - p) < 1e-4


def test_ties_go_to_smaller_keys():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 2.0], [5.0, 5.0, 5.0, 5.0, 5.0]])
    keys = np.array([9, 8, 2, 5, 1])
    at, best = best_of_rows(scores, keys, 2)
    assert keys[at].tolist() == [[2, 5], [1, 2]]
    assert best.tolist() == [[3.0, 3.0], [5.0, 5.0]]
