"""Spelling variants grouped by word: words counted, near words found by an index of variable-length grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import small_batches, stage

# Code points and occurrences a word must have, and how many times a word's occurrences its form must have.
LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5
# One occurrence in so many loses a code point, chosen by hash of document and word (none: no such loss).
NOISE = 199
# Lengths of grams. A gram is at most half as long as a word, so that one edit never reaches all of them.
SHORTEST = 2
LONGEST = 6
# Words that must hold a gram for it to be frequent, and frequent grams that are known at most.
FREQUENT = 32
GRAMS = 32_768
# Words of a list that are compared with each other as they are; a longer list is split further.
LIST = 64
# Words counted in a task before their counts are handed on.
AT_ONCE = 200_000
# Code points of the lists' words that a task hands on at once.
ENTRY_CHARS = 8_000_000

# The letters of words, and those whose case does not matter.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def noisy_words(text: str | None, doc: str, noise: int | None) -> Counter[str]:
    """The words of a text with their counts, some with a code point lost as the contract has it."""
    runs: Counter[str] = Counter()
    # Runs are put in lower case after they are counted: there are far fewer of them then.
    for run, n in Counter(_RUN.findall(text or "")).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    if not noise:
        return runs
    start = crc32(f"{doc}:".encode())
    out: Counter[str] = Counter()
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    noise: int | None = NOISE,
) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough, over whole texts. Counts are added up
    in the tasks, in a table of bounded size, before they are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()

        def counted() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})
            total.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch["doc"], batch["text"], strict=True):
                for word, n in noisy_words(body, doc, noise).items():
                    if len(word) >= least_chars:
                        total[word] += n
                if len(total) >= AT_ONCE:
                    yield counted()
        if total:
            yield counted()

    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


@dataclass(frozen=True)
class GramDictionary:
    """Frequent grams and how many words hold them. The dictionary's grams are those whose proper
    beginnings are all frequent: a frequent gram is replaced by its longer forms, a rare one ends."""

    counts: dict[str, int]
    longest: int = LONGEST
    # What a gram of the dictionary can be after its first code point and before its last one.
    insides: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        inside = {g[i:] for g in self.counts for i in range(1, len(g))}
        object.__setattr__(self, "insides", frozenset(inside))

    def grams(self, word: str, longest: int) -> list[tuple[int, int]]:
        """``(start, end)`` of the variable grams of ``word``: from every place the shortest gram that is
        not frequent, or one of ``longest``; without those that an earlier one covers."""
        counts, size, covered, out = self.counts, len(word), 0, []
        for p in range(size - SHORTEST + 1):
            end = p + SHORTEST
            while end < size and end - p < longest and word[p:end] in counts:
                end += 1
            if end > covered:
                out.append((p, end))
                covered = end
        return out

    def affected(self, word: str, grams: list[tuple[int, int]], longest: int) -> int:
        """The most grams of ``word`` that one inserted, deleted or replaced code point may change.

        A gram is chosen by its own code points only, so an edit changes those that hold it, the last
        ones if it lengthens the word, and those to its right that a new gram across the edit could
        cover; such a gram is no longer than ``longest`` and all its beginnings are frequent.
        """
        size, most, first = len(word), 0, 0
        for at in range(size + 1):
            while first < len(grams) and grams[first][0] <= at - longest:
                first += 1
            # A code point deleted or replaced at ``at``, and one inserted before it.
            changed = inserted = 0
            for p, end in grams[first : first + 2 * longest + 2]:
                if p > at + longest:
                    break
                if p <= at < end:
                    changed += 1
                elif p > at and end <= at + longest and self._coverable(word, at + 1, end):
                    changed += 1
                if p < at < end:
                    inserted += 1
                elif p >= at and end < at + longest and self._coverable(word, at, end):
                    inserted += 1
                elif at == size == end:
                    inserted += 1
            most = max(most, changed, inserted)
        return most

    def _coverable(self, word: str, start: int, end: int) -> bool:
        inside = word[start : end - 1]
        return not inside or inside in self.insides

    def signature(self, word: str, longest: int) -> list[tuple[int, int]]:
        """The rarest grams, one more than an edit can change, in an order that all words share: of two
        near words, the first gram that the edit spares is in both signatures."""
        grams = self.grams(word, longest)
        grams.sort(key=lambda g: (self.counts.get(word[g[0] : g[1]], 0), word[g[0] : g[1]], g[0]))
        return grams[: self.affected(word, sorted(grams), longest) + 1]


def gram_dictionary(words: DataFrame, *, frequent: int = FREQUENT, grams: int = GRAMS, longest: int = LONGEST) -> GramDictionary:
    """The frequent grams of all words, ``grams`` of them at most (the most frequent ones). Which ones
    are known changes how long lists get, never which words are found."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()

        def counted() -> pd.DataFrame:
            out = pd.DataFrame({"gram": list(held.keys()), "n": list(held.values())})
            held.clear()
            return out

        for batch in batches:
            for word in batch["word"]:
                held.update({word[i : i + w] for w in range(SHORTEST, longest + 1) for i in range(len(word) - w + 1)})
                if len(held) >= AT_ONCE:
                    yield counted()
        if held:
            yield counted()

    each = words.select("word").mapInPandas(count, "gram string, n long")
    top = each.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= frequent).orderBy(F.desc("n"), "gram").limit(grams)
    return GramDictionary({r["gram"]: r["n"] for r in top.collect()}, longest)


def list_entries(words: DataFrame, dictionary: GramDictionary, *, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``list, left, cut, m, word, n``: the lists of the index that each word stands in.

    Words of lengths m and m + 1 share an index m, whose grams are at most m / 2 long. An edit lies on
    one side of a gram that it spares, so each gram of a word's signature makes two entries: the gram
    and all to its left (``left``) are equal in a list, and the rest from ``cut`` on is open, or all to its
    right is equal and the rest before ``cut`` is open.
    """

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        columns, out, held = ["list", "left", "cut", "m", "word", "n"], [], 0
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"], strict=True):
                for m in {max(least_chars, len(word) - 1), len(word)}:
                    longest = min(dictionary.longest, m // 2)
                    for start, end in dictionary.signature(word, longest):
                        out.append((xxh3_128_digest(f"{m}<{start}:{word[:end]}".encode()), True, end, m, word, n))
                        out.append((xxh3_128_digest(f"{m}>{end - start}:{word[start:]}".encode()), False, start, m, word, n))
                        held += 2 * len(word) + 100
                if held > ENTRY_CHARS:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)

    return words.select("word", "n").mapInPandas(enter, "list binary, left boolean, cut int, m int, word string, n long")


def one_edit_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point tells ``a`` from ``b``; linear in their length."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def near_words(words: DataFrame, dictionary: GramDictionary, *, least_chars: int = LEAST_CHARS, list_size: int = LIST) -> DataFrame:
    """``word, n, near, near_n`` for all pairs of ``words`` (``word, n``, one row each) that one inserted,
    deleted or replaced code point tells apart, in both directions.

    Lists of at most ``list_size`` words are merged as they are. A longer list is split by the open
    rests of its words, whole and without each of their code points: words that are near share such a
    remnant, and few words of an alphabet can.
    """
    entries = stage(list_entries(words, dictionary, least_chars=least_chars), "spelling-lists")
    lists = entries.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    lists = lists.repartition(F.xxhash64(F.lit("deal"), "list"))
    held = stage(entries.join(lists, "list"), "spelling-held")
    rest = F.expr("if(left, substr(word, cut + 1), substr(word, 1, cut))")
    remnant = F.expr(
        "array_distinct(array_append(transform(sequence(1, greatest(length(rest), 1)),"
        " i -> concat(substr(rest, 1, i - 1), substr(rest, i + 1))), rest))"
    )
    short = held.where(F.col("size") <= list_size).withColumn("part", F.lit(""))
    long = held.where(F.col("size") > list_size).withColumn("rest", rest).withColumn("part", F.explode(remnant))
    kept = ["list", "part", "m", "word", "n"]
    parts = short.select(kept).unionByName(long.select(kept))
    other = parts.select("list", "part", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # One of the two has the index's own length; pairs of longer ones are in the next index.
    fit = (F.col("word") < F.col("near")) & (F.least(F.length("word"), F.length("near")) == F.col("m"))
    verified = F.pandas_udf(lambda x, y: pd.Series([one_edit_apart(a, b) for a, b in zip(x, y, strict=True)], dtype="bool"), "boolean")
    pairs = parts.join(other, ["list", "part"]).where(fit).where(verified("word", "near"))
    once = stage(pairs.select("word", "n", "near", "near_n").distinct(), "spelling-pairs")
    return once.unionByName(
        once.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (a form for each word that has one): the end of each chain. A form
    is more frequent than its word, so there are no circles; steps double until all are at an end."""
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stage(reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return reached


def spelling_groups(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    noise: int | None = NOISE,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs`` that is long and frequent enough.

    Words are runs of letters (A to Z, a to z, U+00C0 to U+00FF) with A to Z in lower case; every
    ``noise``-th by hash of document and word has lost a code point. Two words are near if one
    inserted, deleted or replaced code point tells them apart. A word's form is the near word with
    most occurrences (of equal ones the smallest), if that has ``ratio`` times the word's; ``root`` is
    the end of the chain of forms, the word itself without one.

    Near words are found by lists of variable-length grams (``near_words``) and verified; every pair is
    found whatever the dictionary holds. A null or empty text has no words, a null key is an empty one,
    rows that repeat count each, other columns are not looked at, no rows give no rows.
    """
    if least_chars < 2 * SHORTEST:
        raise ValueError(f"words must have at least {2 * SHORTEST} code points")
    words = stage(
        word_counts(docs, text=text, key=key, least_chars=least_chars, least_count=least_count, noise=noise), "spelling-words"
    )
    near = near_words(words, gram_dictionary(words), least_chars=least_chars)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
    )
    best = best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    rows = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            *(F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")),
        ),
        "spelling-forms",
    )
    ends = roots(rows.where(F.col("form").isNotNull()).select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
