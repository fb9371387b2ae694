"""Each stage on the rows that the one before kept."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from zonewright.llm.toxicity import TOXIC_FROM, fit_on, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "docs")
        stage(spark, docs, FOLDER).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_all_stages_but_the_last_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(steps)[1:]
    for name in list(steps)[:-1]:
        assert steps[name].columns == steps["documents"].columns


def test_toxic_documents_go_and_others_stay(spark, steps):
    docs = steps["documents"]
    model = fit_on(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = {r[0] for r in docs.where(toxicity(model, docs["text"]) < TOXIC_FROM).select("doc_id").collect()}
    assert {r[0] for r in steps["toxicity"].select("doc_id").collect()} == clean


def shingles(text):
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def test_one_of_each_group_of_near_duplicates_stays(steps):
    sets = sorted((r["doc_id"], shingles(r["text"])) for r in steps["toxicity"].collect())
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    assert sorted(r["doc_id"] for r in steps["near_duplicates"].collect()) == [i for i, _ in sets if find(i) == i]


def test_personal_data_is_masked_and_nothing_else(steps):
    before = {r["doc_id"]: r for r in steps["near_duplicates"].collect()}
    after = {r["doc_id"]: r for r in steps["personal_data"].collect()}
    assert before.keys() == after.keys()
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    changed = 0
    for i, r in after.items():
        assert not email.search(r["text"])
        changed += r["text"] != before[i]["text"]
        if not re.search(r"[@+0-9]", before[i]["text"]):
            assert r["text"] == before[i]["text"]
    assert changed


def test_mixing_repeats_small_sources_and_loses_nothing(steps):
    before = {r["doc_id"]: r for r in steps["personal_data"].collect()}
    times = Counter(r["doc_id"] for r in steps["mixing"].collect())
    assert times.keys() == before.keys() and 1 <= max(times.values()) <= 2
    tokens, taken = Counter(), Counter()
    for i, r in before.items():
        tokens[r["source"]] += len(r["text"].split())
        taken[r["source"]] += len(r["text"].split()) * times[i]
    rate = {s: taken[s] / tokens[s] for s in tokens}
    # A larger source is never repeated much more than a smaller one.
    order = sorted(tokens, key=lambda s: -tokens[s])
    assert abs(rate[order[0]] - 1) < 1e-9 and max(rate.values()) <= corpus_pipeline.MAX_REPEATS + 1e-9


def test_all_that_is_left_is_packed(steps):
    given = Counter(r["doc_id"] for r in steps["mixing"].collect())
    by, sequences = defaultdict(list), defaultdict(int)
    for r in steps["packing"].collect():
        by[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]] += r["length"]
    assert by.keys() == given.keys() and max(sequences.values()) <= 1024
    for i, pieces in by.items():
        assert Counter(s for s, _ in pieces)[0] == given[i]
