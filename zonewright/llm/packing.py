"""Token sequences of a fixed length, packed by the sum-of-squares rule."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import small_batches, stage

LENGTH = 1024
END = 2
# Pieces that one task packs at a time, and the most rounds of packing anew what is not full.
BLOCK = 8192
ROUNDS = 4

# Fixed value: how a byte-level vocabulary of this family splits a text before it merges bytes.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# That pattern backtracks through a run of white space and gives up at about 1,000,000 characters;
# runs from this length on are split without it. White space is what the pattern's ``\s`` is.
LONG_RUN = 100_000
_LONG_SPACE = re.compile(
    rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}"
)


@cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids by the vocabulary file ``path``, once for each Python worker.

    The ids are those of the ``tokenizers`` library without special tokens; the faster library
    that makes them here takes the same vocabulary as bytes and ranks. The file spells the bytes
    that are not printable as the characters from 256 on.

    A long run of white space is cut out where ``SPLIT`` would cut it: the run is one part, but
    for its last character if more text follows, which belongs to what follows.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(printable))
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"] for t in spec["added_tokens"] if t["special"]}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
    model = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @cache
    def unsplit() -> Callable[[str], list[int]]:
        return tiktoken.Encoding(path, pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(text: str) -> list[int]:
        ids, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += model.encode_ordinary(text[at : run.start()])
            ids += unsplit()(text[run.start() : end])
            at = end
        return ids + model.encode_ordinary(text[at:]) if at else model.encode_ordinary(text)

    return encode


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: all full but for the first."""
    first = n % length
    ends = range(first, n + 1, length) if first else range(length, n + 1, length)
    return [(max(0, end - length), min(length, end)) for end in ends]


def tokenized_pieces(
    docs: DataFrame, vocabulary: str, *, length: int = LENGTH, end: int = END, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a row for each piece of each document."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            doc, number, starts, lengths, crcs = [], [], [], [], []
            for at, body in enumerate(batch["text"]):
                ids = np.array([*encode(body or ""), end], dtype="<u4")
                for n, (start, size) in enumerate(cut(len(ids), length)):
                    doc.append(at)
                    number.append(n)
                    starts.append(start)
                    lengths.append(size)
                    crcs.append(crc32(ids[start : start + size]))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].to_numpy()[doc],
                    "piece": np.asarray(number, dtype="int32"),
                    "start": np.asarray(starts, dtype="int64"),
                    "length": np.asarray(lengths, dtype="int64"),
                    "ids_crc32": np.asarray(crcs, dtype="int64"),
                }
            )

    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(
        pieces, "doc_id string, piece int, start long, length long, ids_crc32 long"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, place in it and final gap of its bin, for each item.

    Items come longest first. Each goes to the gap, an empty bin's included, that makes
    the sum over gaps of (open bins with that gap) squared smallest; full bins do not
    count. Ties go to the tightest gap, then to the bin opened last.
    """
    open_bins = np.zeros(capacity + 1, dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    chosen = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    never = np.int64(1) << 60
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # Square sums change by 2 (to - from + 1); a bin that closes leaves only its old gap.
        left = open_bins[: capacity - size + 1]
        old = open_bins[size:]
        change = np.where(old > 0, 2 * (left - old + 1), never)
        change[0] = 1 - 2 * old[0] if old[0] else never
        change[-1] = 2 * left[-1] + 1 if size < capacity else 0
        gap = int(change.argmin()) + size
        if gap == capacity:
            b = len(gap_of)
            gap_of.append(capacity)
        else:
            b = by_gap[gap].pop()
            open_bins[gap] -= 1
        chosen[i], offset[i] = b, capacity - gap
        gap_of[b] = gap = gap - size
        if gap:
            open_bins[gap] += 1
            by_gap[gap].append(b)
    return chosen, offset, np.asarray(gap_of, dtype=np.int64)[chosen]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it for each item, longest first, each into the tightest gap it fits."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    chosen = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    bins = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        gap = size + int((count[size:] > 0).argmax()) if size <= capacity else capacity
        if count[gap]:
            count[gap] -= 1
            b = by_gap[gap].pop()
        else:
            gap, b = capacity, bins
            bins += 1
        chosen[i], offset[i] = b, capacity - gap
        by_gap[gap - size].append(b)
        count[gap - size] += 1
    return chosen, offset


def pack(pieces: DataFrame, *, length: int = LENGTH, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a sequence holds ``length`` ids at most.

    A full piece is a sequence of its own. The others are dealt by row into blocks of about
    ``block`` pieces, each packed in one task by the sum-of-squares rule. Full sequences
    stay; the pieces of the others are dealt anew, into ever fewer blocks, until one block is
    left or ``rounds`` are over. What the last round leaves in sequences that are not full is
    placed by best fit, longest first, which closes a finite list better than the rule does
    (it keeps gaps open for pieces still to come). So no task packs more than a block. A
    sequence is named by the smallest row number in it.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def filler(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def fill(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("row", ignore_index=True)
            bins, offset, gap = sum_of_squares(group["length"].to_numpy(), length)
            if last and (gap > 0).any():
                rest = np.flatnonzero(gap)
                anew, offset[rest] = best_fit(group["length"].to_numpy()[rest], length)
                bins[rest] = anew + len(bins)
            first = group["row"].groupby(bins).transform("min")
            return group.drop(columns="block").assign(sequence_id=first, offset=offset, gap=gap)

        return fill

    numbered = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    done = numbered.where(F.col("length") >= length).select(
        *columns, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.where(F.col("length") < length)
    for n in range(rounds):
        blocks = math.ceil(rest.count() / block)
        if not blocks:
            break
        last = blocks == 1 or n == rounds - 1
        packed = stage(
            rest.withColumn("block", F.pmod(F.xxhash64(F.lit(n), "row"), F.lit(blocks)))
            .groupBy("block")
            .applyInPandas(filler(last), f"{schema}, row long, sequence_id long, offset long, gap long"),
            "packed",
        )
        done = done.unionByName(
            packed.where(F.lit(True) if last else F.col("gap") == 0).select(*columns, "sequence_id", "offset")
        )
        if last:
            break
        rest = packed.where("gap > 0").select(*columns, "row")
    return done


def packed_documents(
    docs: DataFrame, vocabulary: str, *, length: int = LENGTH, end: int = END, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """All of ``docs`` as pieces in sequences:
    ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids by the vocabulary and ``end``; if longer than ``length``, it is
    cut into full pieces, of which the first may be shorter. A null or empty text is the
    single id ``end``; a null key stays null; repeated rows are documents of their own;
    no rows give no rows; other columns are not looked at. ``start`` counts the
    document's ids before the piece, ``offset`` those of the sequence.
    """
    pieces = tokenized_pieces(docs, vocabulary, length=length, end=end, text=text, key=key)
    kind = docs.schema[key].dataType
    out = pack(pieces, length=length)
    return out.select(F.col("doc_id").cast(kind).alias(key), *[c for c in out.columns if c != "doc_id"])
