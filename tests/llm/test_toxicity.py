from zlib import crc32

import numpy as np
import pandas as pd

from zonewright.llm import toxicity
from zonewright.llm.toxicity import fit, fit_numbers, score_documents, without_toxic, words_of

INSULTS = "idiot moron scum loser".split()
DOCS = "doc_id long, text string, score string, k long"


def sentences(n, seed, share=0.3):
    """Some with insults; half of those, and few others, name a group of people."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = [f"word{chr(97 + int(i) % 26)}{chr(97 + int(i) // 26)}" for i in rng.integers(0, 300, 20)]
        bad = rng.random() < share
        if bad:
            words[3:3] = [INSULTS[int(i)] for i in rng.integers(0, 4, 2)]
        if rng.random() < (0.6 if bad else 0.05):
            words[8:8] = ["muslim"]
        out.append((" ".join(words), int(bad)))
    return out


def tables(spark, texts, extra=()):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, (t, _) in enumerate(texts)] + [(i, t, "x", 1) for i, t in extra], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(texts)] + [(None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    texts = sentences(900, 1)
    docs, labels = tables(spark, texts, [(5000, None), (5001, ""), (5002, "ok " * 50_000), (None, "scum idiot"), (5003, "idiot moron scum"), (5003, "idiot moron scum")])
    rows = score_documents(docs, labels).collect()
    assert len(rows) == 906
    by = {r["doc_id"]: r for r in rows}
    right = 0
    for i, (_, y) in enumerate(texts):
        r = by[i]
        assert r["held_out"] == (crc32(str(i).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1
        right += r["held_out"] and r["predicted"] == y
    assert right >= 0.98 * sum(by[i]["held_out"] for i in range(900))
    assert by[5000]["score"] == by[5001]["score"] < 0.5
    assert by[None]["predicted"] == by[5003]["predicted"] == 1 and not by[None]["held_out"]


def test_swapping_groups_changes_little(monkeypatch):
    # Half of the toxic texts have lost their insults, so that naming a group tells them best.
    texts = [
        (" ".join(w for w in t.split() if w not in INSULTS) if y and i % 2 else t, y)
        for i, (t, y) in enumerate(sentences(800, 2))
    ]
    words, label = [words_of(t) for t, _ in texts], np.array([float(y) for _, y in texts])
    regular = fit(words, label)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    free = fit(words, label)
    neutral = pd.Series([" ".join(t.replace("muslim", "").split()[:18]) + " muslim" for t, y in texts if not y])
    plain = pd.Series([t.replace("muslim", "old") for t in neutral])

    def change(model):
        return float((model.score(neutral) - model.score(plain)).abs().mean())

    assert change(free) > 0.05
    assert change(regular) < 0.3 * change(free)
    assert (regular.score(neutral) >= 0.7).sum() < 0.5 * (free.score(neutral) >= 0.7).sum()


def test_without_labels_all_scores_are_one(spark):
    docs, labels = tables(spark, [("a", 0), ("b", 0)])
    assert len({r["score"] for r in score_documents(docs, labels.limit(0)).collect()}) == 1
    assert score_documents(docs.limit(0), labels).count() == 0


def test_a_key_that_repeats_is_fitted_once(spark, monkeypatch):
    texts = sentences(60, 4)
    docs, labels = tables(spark, texts)
    often = next(i for i, _ in enumerate(texts) if crc32(str(i).encode()) % 3 != 1)
    again = spark.range(30_000).selectExpr(f"{often}L AS doc_id", f"'{texts[often][0]}' AS text", "'x' AS score", "1L AS k")
    fitted = []
    monkeypatch.setattr(toxicity, "fit_numbers", lambda names, rows, label: fitted.append(len(rows)) or fit_numbers(names, rows, label))
    toxicity.fit_on(docs.unionByName(again), labels)
    assert fitted == [sum(crc32(str(i).encode()) % 3 != 1 for i in range(60))]


def test_features_counted_in_tasks_are_those_counted_here(spark):
    texts = sentences(300, 6)
    docs, labels = tables(spark, texts)
    learnt = [(words_of(t), float(y)) for i, (t, y) in enumerate(texts) if crc32(str(i).encode()) % 3 != 1]
    here, there = fit([w for w, _ in learnt], np.array([y for _, y in learnt])), toxicity.fit_on(docs, labels)
    some = pd.Series([t for t, _ in texts])
    assert np.allclose(here.score(some), there.score(some), atol=1e-6)


def test_the_stage_keeps_clean_rows_whole(spark):
    texts = sentences(600, 3)
    docs, labels = tables(spark, texts)
    model = toxicity.fit_on(docs, labels)
    left = without_toxic(docs, model)
    assert left.schema == docs.schema
    assert {r["doc_id"] for r in left.collect()} == {i for i, (_, y) in enumerate(texts) if not y}
