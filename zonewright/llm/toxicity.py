"""Toxicity scores that do not hang on which group of people a text names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import small_batches, stage

# Labelled rows of each class the model is fitted on at most, chosen by hash.
SAMPLE = 2500
# Features the model may use at most, and the documents of the sample one must be in.
FEATURES = 1024
SEEN = 3
# Tasks that read the sample, and features that one of them counts at once.
SAMPLE_PARTS = 16
FEATURES_AT_ONCE = 200_000
# Lengths of word beginnings that are features beside whole words, for inflected forms.
BEGINNINGS = (4, 5, 6)
# Penalties on weights (over the root of the number of documents), squared weights and squared
# score changes under a swap; swaps a document.
SPARSE = 0.01
SMOOTH = 1e-6
COUNTERFACTUAL = 1.0
SWAPS = 2
STEPS = 300
TOXIC_FROM = 0.7

# Words that name groups of people, in the languages of the corpus.
IDENTITY_TERMS = (
    "african american arab asian atheist black blind buddhist catholic christian deaf disabled female foreigner gay "
    "heterosexual hindu hispanic homosexual immigrant indian indigenous jew jewish latino lesbian male man mexican "
    "migrant muslim old queer refugee straight trans transgender turkish white woman women young "
    "ausländer behinderter christ flüchtling frau frauen jude juden lesbisch mann moslem schwarz schwul türke weiß "
    "arabe chrétien étranger femme femmes handicapé homme immigré juif lesbienne musulman noir réfugié "
    "árabe cristiano discapacitado extranjero hombre inmigrante judío lesbiana mujer mujeres musulmán negro refugiado"
).split()

_WORD = re.compile(r"[^\W\d_]+")
_IDENTITY = frozenset(IDENTITY_TERMS)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """Whole words, and their beginnings marked with a hyphen."""
    return words.union(*({w[:n] + "-" for w in words if len(w) >= n} for n in BEGINNINGS))


def swapped(words: set[str], have: set[str], seed: int) -> list[tuple[set[str], set[str]]]:
    """Features that are lost and gained in the same sentence about another group: the groups it
    names become another one; a text that names none gets one, which must not matter either.
    ``have`` are the features of ``words``."""
    named = words & _IDENTITY
    left = features_of(words - named) if named else have
    out = []
    for n in range(SWAPS):
        new = features_of({IDENTITY_TERMS[(seed + n * 37) % len(IDENTITY_TERMS)]}) - left
        old = features_of(named) - left
        out.append((old - new, new - old))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    intercept: float
    weights: dict[str, float]

    def score(self, texts: pd.Series) -> pd.Series:
        by_length: dict[int, dict[str, float]] = {n: {} for n in (0, *BEGINNINGS)}
        for f, w in self.weights.items():
            by_length[len(f) - 1 if f.endswith("-") else 0][f.rstrip("-")] = w
        whole, starts = by_length.pop(0), list(by_length.items())
        out = []
        for text in texts:
            words = words_of(text)
            z = self.intercept + sum(whole[w] for w in whole.keys() & words)
            for n, weights in starts:
                z += sum(weights[w] for w in weights.keys() & {w[:n] for w in words})
            out.append(z)
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))), dtype="float64")


def _rows_and_columns(hits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which features each row has, as two arrays."""
    sizes = np.array([len(h) for h in hits], dtype=np.int64)
    columns = np.concatenate(hits) if len(hits) else np.empty(0)
    return np.repeat(np.arange(len(hits)), sizes), columns.astype(np.int64)


def _numbers(features: set[str], column: dict[str, int]) -> np.ndarray:
    return np.array(sorted(column[f] for f in column.keys() & features), dtype=np.int32)


def numbered(words: set[str], column: dict[str, int]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The numbers of a document's features, and of those that each of its swapped forms loses and gains."""
    have = features_of(words)
    forms = swapped(words, have, crc32(" ".join(sorted(words)[:5]).encode()))
    return _numbers(have, column), [_numbers(old, column) for old, _ in forms], [_numbers(new, column) for _, new in forms]


def _chosen(words: list[set[str]], label: np.ndarray) -> list[str]:
    """Features that stand out most between the classes, and those of identity terms."""
    inside, outside = Counter(), Counter()
    for w, y in zip(words, label, strict=True):
        (inside if y else outside).update(features_of(w))
    pos, neg = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    ranked = []
    for f in inside.keys() | outside.keys():
        a, b = inside[f], outside[f]
        if a + b >= SEEN:
            p, q = (a + 0.5) / (pos + 1), (b + 0.5) / (neg + 1)
            ranked.append((-abs(np.log(p / q)) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)), f))
    ranked.sort()
    return _with_identity([f for _, f in ranked[:FEATURES]], inside.keys() | outside.keys())


def _with_identity(features: list[str], seen: Iterable[str]) -> list[str]:
    return features + sorted(features_of(set(_IDENTITY)).intersection(seen) - set(features))


def fit(words: list[set[str]], label: np.ndarray) -> ToxicityModel:
    """The model of documents that are at hand, as sets of words."""
    if not len(label) or label.min() == label.max():
        return _without_classes(label)
    names = _chosen(words, label)
    column = {f: i for i, f in enumerate(names)}
    return fit_numbers(names, [numbered(w, column) for w in words], label)


def _without_classes(label: np.ndarray) -> ToxicityModel:
    share = float(label.mean()) if len(label) else 0.0
    return ToxicityModel(float(np.log((share + 0.01) / (1.01 - share))), {})


def fit_numbers(
    names: list[str], documents: list[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]], label: np.ndarray
) -> ToxicityModel:
    """Logistic regression with sparse weights, both classes weighed alike. For every document
    and each of its swapped forms, the squared change of the log-odds is added to the loss."""
    row, at = _rows_and_columns([whole for whole, _, _ in documents])
    row_l, at_l = _rows_and_columns([x for _, lost, _ in documents for x in lost])
    row_g, at_g = _rows_and_columns([x for _, _, gained in documents for x in gained])
    pairs, n, f = sum(len(lost) for _, lost, _ in documents), len(label), len(names)
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (n - label.sum()))

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(row, w[at], n) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        g = np.bincount(at, error[row], f) + SMOOTH * w
        change = np.bincount(row_l, w[at_l], pairs) - np.bincount(row_g, w[at_g], pairs)
        pull = 2 * COUNTERFACTUAL / pairs * change
        g += np.bincount(at_l, pull[row_l], f) - np.bincount(at_g, pull[row_g], f)
        return g, float(error.sum())

    # Accelerated proximal steps, a feature's step by the rows it is in: a rare feature takes
    # longer ones. Row lengths times row weights bound the second derivatives.
    wide = weight * (1 + np.bincount(row, minlength=n))
    apart = 2 * COUNTERFACTUAL / pairs * (np.bincount(row_l, minlength=pairs) + np.bincount(row_g, minlength=pairs))
    curved = 0.25 * np.bincount(at, wide[row], f) + np.bincount(at_l, apart[row_l], f) + np.bincount(at_g, apart[row_g], f)
    step, step_b = 1 / (curved + SMOOTH), 4 / wide.sum()
    sparse = SPARSE / np.sqrt(n)
    w = y = np.zeros(f)
    b = c = 0.0
    t = 1.0
    for _ in range(STEPS):
        g, gb = gradient(y, c)
        new = y - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * sparse, 0)
        new_b = c - step_b * gb
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, c = new + (t - 1) / grown * (new - w), new_b + (t - 1) / grown * (new_b - b)
        w, b, t = new, new_b, grown
    return ToxicityModel(float(b), {name: float(x) for name, x in zip(names, w, strict=True) if x})


def held_out(key: Column) -> Column:
    """Rows never learnt from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    """The model from ``SAMPLE`` labelled rows of each class at most, none of them held out. A key
    that has several labels counts as toxic if one says so."""
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("k"))
        .agg((F.max(label) > 0).cast("int").alias("y"))
    )
    size = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    scale, wanted = 1 << 30, F.lit(False)
    for y, n in size.items():
        share = int(scale * min(1.0, SAMPLE / n))
        wanted = wanted | ((F.col("y") == y) & (F.pmod(F.xxhash64(F.lit("fit"), "k"), F.lit(scale)) < share))
    small_batches(docs.sparkSession)
    # About SAMPLE keys of each class, so they fit anywhere; the limit makes it a bound. A key that repeats
    # in the documents is one row, that of its first text.
    chosen = known.where(wanted).limit(3 * SAMPLE)
    body = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("body"))
    sample = body.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("body").alias("body"))
    sample = stage(sample, "toxicity-sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return _without_classes(np.array([float(y) for y, n in classes.items() for _ in range(n)]))
    names = _chosen_of(sample, classes)
    column = {f: i for i, f in enumerate(names)}
    forms = ["whole", *(f"{kind}{n}" for n in range(SWAPS) for kind in ("lost", "gained"))]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for body_ in batch["body"]:
                whole, lost, gained = numbered(words_of(body_), column)
                rows.append([whole, *(x for pair in zip(lost, gained, strict=True) for x in pair)])
            yield pd.DataFrame(rows, columns=forms).assign(k=batch["k"].to_numpy(), y=batch["y"].to_numpy())

    # What comes to the driver is a row of feature numbers for each sampled document.
    schema = ", ".join([*(f"{f} array<int>" for f in forms), f"k {sample.schema['k'].dataType.simpleString()}", "y int"])
    found = sample.repartition(SAMPLE_PARTS, "k").mapInPandas(number, schema).toPandas().sort_values("k", ignore_index=True)
    documents = [
        (whole, list(swaps[0::2]), list(swaps[1::2])) for whole, *swaps in zip(*(found[f] for f in forms), strict=True)
    ]
    return fit_numbers(names, documents, found["y"].to_numpy(dtype="float64"))


def _chosen_of(sample: DataFrame, classes: dict[int, int]) -> list[str]:
    """As ``_chosen``, for sampled rows ``k, y, body``: features are counted by class in the tasks, and only
    those that stand out come to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def counted() -> pd.DataFrame:
            names = list(held[0].keys() | held[1].keys())
            out = pd.DataFrame({"f": names, "a": [held[1][f] for f in names], "b": [held[0][f] for f in names]})
            for part in held:
                part.clear()
            return out

        for batch in batches:
            for y, body in zip(batch["y"], batch["body"], strict=True):
                held[y].update(features_of(words_of(body)))
                if len(held[0]) + len(held[1]) >= FEATURES_AT_ONCE:
                    yield counted()
        if held[0] or held[1]:
            yield counted()

    counts = sample.repartition(SAMPLE_PARTS, "k").mapInPandas(count, "f string, a long, b long")
    counts = stage(counts.groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "toxicity-features")
    p, q = (F.col("a") + 0.5) / (classes[1] + 1), (F.col("b") + 0.5) / (classes[0] + 1)
    apart = F.abs(F.log(p / q)) / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    ranked = counts.where(F.col("a") + F.col("b") >= SEEN).select("f", apart.alias("apart"))
    best = [r["f"] for r in ranked.orderBy(F.desc("apart"), "f").limit(FEATURES).collect()]
    seen = counts.where(F.col("f").isin(sorted(features_of(set(_IDENTITY))))).select("f").collect()
    return _with_identity(best, [r["f"] for r in seen])


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The score of each text, 0 to 1; a null text is an empty one."""
    return F.pandas_udf(model.score, "double")(text.cast("string"))


def score_documents(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "toxic"
) -> DataFrame:
    """``key, held_out, score, predicted`` for every row of ``docs``.

    The classifier is logistic regression over the words of a text and their beginnings; it sees
    neither keys nor other columns. It is fitted on a bounded sample of ``labels`` (``fit_on``),
    with a penalty on every change of a score when identity terms are swapped, so that a
    neutral mention of a group does not make a text toxic. A null or empty text has the score
    of no words; a null key is scored and not held out; repeated rows are scored each; without
    labels of both classes all texts get one score; no rows give no rows.
    """
    model = fit_on(docs, labels, text=text, key=key, label=label)
    return docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), toxicity(model, F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= TOXIC_FROM).cast("int")
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under ``TOXIC_FROM``."""
    return docs.where(toxicity(model, F.col(text)) < TOXIC_FROM)
