from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonewright.llm import packing
from zonewright.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, row string, block long"


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary())
    model.encode_special_tokens = True
    return model


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_ids_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    model = test_ids_are_those_of_the_library.__dict__.setdefault("model", Tokenizer.from_file(vocabulary()))
    model.encode_special_tokens = True
    assert packing.encoder(vocabulary())(text) == model.encode(text, add_special_tokens=False).ids


def test_special_strings_and_odd_spaces_are_text(model):
    for text in ("a<|endoftext|>b", "a  b   c\n\n d \t e ", "don't we'll", " ", " x  y", "x" * 5000):
        assert packing.encoder(vocabulary())(text) == model.encode(text, add_special_tokens=False).ids


def test_long_runs_of_white_space(model):
    spaces = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
    assert all(c.isspace() for c in spaces)
    for text in (
        "one" + " " * 1_100_000 + "two", "\n" * 1_100_000 + "two", "one " + "\t" * 1_100_000, "a" + " " * 1_100_000 + "\n!",
        "a" + spaces * 6000 + "b" + spaces * 5000 + " 1", " " * 99_999 + "a" + " " * 100_000 + "b" + " " * 100_001 + "'s", " " * 100_000,
    ):
        assert packing.encoder(vocabulary())(text) == model.encode(text, add_special_tokens=False).ids


def test_a_document_with_a_long_run_of_white_space(spark, model):
    text = "one" + " " * 1_100_000 + "two"
    rows = packing.packed_documents(spark.createDataFrame([(1, text, "x", 1), (2, "a", "x", 1)], SCHEMA), vocabulary()).collect()
    ids = [*model.encode(text, add_special_tokens=False).ids, packing.END]
    got = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows}
    assert got.keys() == {(1, n) for n in range(len(packing.cut(len(ids), 1024)))} | {(2, 0)}
    for n, (start, size) in enumerate(packing.cut(len(ids), 1024)):
        assert got[1, n] == crc32(np.array(ids[start : start + size], dtype="<u4"))


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (4, [(0, 4)]), (5, [(0, 1), (1, 4)]), (8, [(0, 4), (4, 4)]), (9, [(0, 1), (1, 4), (5, 4)])])
def test_only_the_first_piece_is_short(n, want):
    assert packing.cut(n, 4) == want


def plain_sum_of_squares(lengths, capacity):
    """The rule word for word: try every gap, add up all squares."""
    gaps = []
    for size in sorted(lengths, reverse=True):
        choices = {}
        for i, gap in [*enumerate(gaps), (len(gaps), capacity)]:
            if gap >= size:
                after = [*gaps, capacity]
                after[i] -= size
                if i < len(gaps):
                    after.pop()
                count = Counter(g for g in after if 0 < g < capacity)
                choices.setdefault((sum(c * c for c in count.values()), gap), i)
        i = choices[min(choices)]
        if i == len(gaps):
            gaps.append(capacity)
        gaps[i] -= size
    return sorted(gaps)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=30))
def test_rule_agrees_with_trying_everything(lengths):
    bins, offset, gap = packing.sum_of_squares(np.array(lengths, dtype=np.int64), 20)
    left = {b: 20 - sum(s for s, c in zip(lengths, bins, strict=True) if c == b) for b in set(bins.tolist())}
    assert sorted(left.values()) == plain_sum_of_squares(lengths, 20)
    assert [left[b] for b in bins.tolist()] == gap.tolist()


def check_sequences(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_documents_come_back_whole(spark, model):
    texts = ["one two three", None, "", "word " * 40, "word " * 40, "é" * 33, "a", " "]
    docs = spark.createDataFrame([(i if i != 6 else None, t, "x", 1) for i, t in enumerate(texts)] + [(0, texts[0], "x", 1)], SCHEMA)
    out = packing.packed_documents(docs, vocabulary(), length=16)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.schema["doc_id"].dataType.simpleString() == "bigint"
    rows = out.collect()
    check_sequences(rows, 16)
    want = Counter()
    for i, t in [*enumerate(texts), (0, texts[0])]:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 2]
        for n, (start, size) in enumerate(packing.cut(len(ids), 16)):
            part = np.array(ids[start : start + size], dtype="<u4")
            want[(i if i != 6 else None, n, start, size, crc32(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want


def test_many_blocks_pack_about_as_well_as_one(spark):
    rng = np.random.default_rng(3)
    sizes = [int(x) for x in rng.integers(1, 1024, 3000)]
    rows = [(str(i), 0, 0, s, 0) for i, s in enumerate(sizes)]
    pieces = spark.createDataFrame(rows, "doc_id string, piece int, start long, length long, ids_crc32 long")
    one = check_sequences(packing.pack(pieces, block=5000).collect(), 1024)
    many = packing.pack(pieces, block=300).collect()
    assert len(many) == 3000
    least = -(-sum(sizes) // 1024)
    assert one <= least * 1.02
    assert check_sequences(many, 1024) <= least * 1.03


def test_no_documents(spark):
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA), vocabulary()).count() == 0
