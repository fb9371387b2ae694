import math
import re
from collections import Counter, defaultdict

import pytest

from zonewright.llm.mixing import mix_documents, remixed, source_sizes, temper

SCHEMA = "doc_id long, text string, source string, block string, bucket long"
SIZES = {"big": 400, "mid": 100, "small": 50, None: 25}


def corpus(spark, sizes=SIZES, words=4):
    rows, n = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            rows.append((n, " ".join(["w"] * (1 + n % (2 * words))), source, "x", 1))
            n += 1
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def tokens_of(docs):
    out = Counter()
    for r in docs.collect():
        out[r["source"]] += len((r["text"] or "").split())
    return out


def exponent_by_bisection(tokens, fits):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


def weights(tokens, e):
    total = sum(tokens.values())
    power = {s: (t / total) ** e for s, t in tokens.items()}
    norm = sum(power.values())
    return {s: p / norm for s, p in power.items()}


def sized(spark, docs):
    from pyspark.sql import functions as F

    from zonewright.llm.mixing import token_count

    return source_sizes(docs.withColumn("t", token_count(F.col("text"))), "source", "t")


def test_exponent_meets_the_repetition_limit(spark):
    docs = corpus(spark)
    tokens = tokens_of(docs)

    def repeats(e):
        w = weights(tokens, e)
        return max(w[s] / tokens[s] for s in tokens) * max(tokens[s] / w[s] for s in tokens)

    got = temper(sized(spark, docs), max_repeats=3.0)
    assert abs(got.exponent - exponent_by_bisection(tokens, lambda e: repeats(e) <= 3.0)) < 1e-6


def test_exponent_meets_the_entropy(spark):
    docs = corpus(spark)
    tokens = tokens_of(docs)

    def entropy(e):
        return -sum(w * math.log(w) for w in weights(tokens, e).values())

    target = (entropy(1) + math.log(len(tokens))) / 2
    got = temper(sized(spark, docs), target_entropy=target, max_repeats=None)
    assert abs(entropy(got.exponent) - target) < 1e-6


def test_limits_that_cannot_be_met_give_one(spark):
    assert temper(sized(spark, corpus(spark)), budget=1e9, max_repeats=2.0).exponent == 1.0


def test_quotas_are_filled_and_no_document_is_lost(spark):
    docs = corpus(spark)
    tokens = tokens_of(docs)
    mixture = temper(sized(spark, docs), max_repeats=2.5)
    w = weights(tokens, mixture.exponent)
    taken, times = Counter(), defaultdict(Counter)
    for r in mix_documents(docs, max_repeats=2.5).collect():
        taken[r["source"]] += r["n_tokens"]
        times[r["source"]][r["doc_id"]] += 1
    for source, t in tokens.items():
        quota = w[source] * mixture.budget
        assert quota - 8 <= taken[source] <= quota + 1
        assert len(times[source]) == SIZES[source]
        assert max(times[source].values()) - min(times[source].values()) <= 1
        assert max(times[source].values()) <= math.ceil(quota / t - 1e-6)


def test_blocks_hold_all_sources_by_weight(spark, monkeypatch):
    from zonewright.llm import mixing

    docs = corpus(spark, {"a": 900, "b": 300}, 2)
    monkeypatch.setattr(mixing.mixed, "__kwdefaults__", mixing.mixed.__kwdefaults__ | {"block_tokens": 500, "bucket_rows": 50})
    by = defaultdict(Counter)
    for r in mix_documents(docs, max_repeats=1.0).collect():
        by[r["block"]][r["source"]] += r["n_tokens"]
    assert len(by) == math.ceil(sum(tokens_of(docs).values()) / 500)
    for block in by.values():
        assert abs(block["a"] / (block["a"] + block["b"]) - 0.75) < 0.05


def test_a_budget_takes_the_beginning_of_an_order(spark):
    docs = corpus(spark)
    rows = mix_documents(docs, budget=500.0, max_repeats=1.0).collect()
    assert 500 - 8 * 4 <= sum(r["n_tokens"] for r in rows) <= 501
    assert {tuple(r) for r in rows} == {tuple(r) for r in mix_documents(docs.repartition(7), budget=500.0, max_repeats=1.0).collect()}


def test_odd_rows(spark):
    odd = spark.createDataFrame(
        [(1, None, "a", "x", 1), (2, "", "a", "x", 1), (3, "one two", "a", "x", 1), (None, "one", "a", "x", 1),
         (4, "", "empty", "x", 1), (3, "one two", "a", "x", 1), (5, "w " * 30_000, None, "x", 1)], SCHEMA
    )
    got = Counter((r["doc_id"], r["pass"]) for r in mix_documents(odd, max_repeats=1.0).collect())
    assert got == {(1, 0): 1, (2, 0): 1, (3, 0): 2, (None, 0): 1, (5, 0): 1}
    assert mix_documents(odd.limit(0)).count() == 0
    assert mix_documents(odd.where("source = 'empty'")).count() == 0


def test_the_stage_returns_the_rows_themselves(spark):
    docs = corpus(spark)
    out = remixed(docs, max_repeats=1.5)
    assert out.schema == docs.schema
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in docs.collect()}
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_the_stage_keeps_sources_without_tokens(spark):
    rows = [
        (1, "one two", "a", "x", 1), (2, "", "a", "x", 1), (3, None, "empty", "x", 1), (4, " \n\t", "empty", "x", 1),
        (4, " \n\t", "empty", "x", 1), (None, "", None, "x", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, remixed(docs, max_repeats=1.0).collect())) == Counter(rows)
    blank = docs.where("doc_id is null or doc_id > 2")
    assert Counter(map(tuple, remixed(blank).collect())) == Counter(rows[2:])
    # A null source that has tokens is taken by its weight only.
    more = docs.union(spark.createDataFrame([(7, "three", None, "x", 1)], SCHEMA))
    assert Counter(r["doc_id"] for r in remixed(more, max_repeats=1.0).collect()) == {1: 1, 2: 1, 3: 1, 4: 2, None: 1, 7: 1}
    assert remixed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("key", [1])
def test_a_source_of_a_third_of_all_rows(spark, key):
    docs = corpus(spark, {"hot": 3000, **{f"s{i}": 20 for i in range(30)}}, 2)
    assert len({r["doc_id"] for r in mix_documents(docs, max_repeats=2.0).collect()}) == 3600
