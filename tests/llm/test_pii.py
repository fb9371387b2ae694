import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonewright.llm.pii import expectation_maximisation, find_personal_data, fit_classifier, masked

SCHEMA = "doc_id long, text string, spans string, s long"

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    None, "", " ", "no data here, 12 apples", "mail é a.b@c.de, x@y.z.w and a@b.c_d@e.f. a@b@c.d @x.y a@b.",
    "1.2.3.4 256.1.1.1 0255.000.1.1 1.2.3.4.5.6.7.8 9.9.9 1.2.3.4567", "card 4111 1111 1111 1111 or 4111-1111-1111-1112 4111  1111",
    "4387513035237269", "+1 (705) 555-1902 and +49 30 1234567. +1 2 + 3 +123456789012345678", "😀 +44 20 7946 0958 x@mail.example.com 10.0.0.1",
    "a@b.c " * 300, "9" * 5000 + " " + "a." * 4000 + "b", "x" * 20_000 + "@y.com", "@" * 3000, "+1" + " " * 3000 + "2",
    "call 0.0.0.0 00000000000000 +1234567890 @ 1@2.3.4.5",
]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def compare(spark, texts):
    for r in find_personal_data(table(spark, texts)).collect():
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == sha256(",".join(want).encode()).hexdigest(), texts[r["doc_id"]]
        assert r["spans"].split(",")[: len(want)] == (want or r["spans"].split(",")[:0])
        for kind in BASE:
            assert r[f"n_{kind}"] == sum(w.startswith(kind + ":") for w in want)


def test_base_spans_are_those_of_the_plain_patterns(spark):
    compare(spark, TEXTS)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+- ()0_Z9é\n", max_size=40), min_size=60, max_size=60))
def test_base_spans_of_random_texts(spark, texts):
    compare(spark, texts)


def test_added_spans_need_more_than_a_form(spark):
    texts = ["please contact jane.roe [at] mail [dot] example [dot] com today", "phone (705) 555-1902 ext", "nothing"] * 5
    texts += ["version (100) 200-3000 of the part", "he was at home dot we went"] * 5
    got = {texts[r["doc_id"]]: r["spans"] for r in find_personal_data(table(spark, texts)).collect()}
    assert got[texts[0]].startswith("email_spelled:15:")
    assert got["nothing"] == "" and got["he was at home dot we went"] == ""


def test_no_documents(spark):
    assert find_personal_data(table(spark, [])).count() == 0


def test_masking_keeps_rows_and_columns(spark):
    texts = [None, "", "plain", "é write a@b.cd or +1 (705) 555-1902, 1.2.3.4!", "4111 1111 1111 1111"]
    docs = table(spark, texts)
    out = masked(docs)
    assert out.schema == docs.schema
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == [
        None, "", "plain", "é write <EMAIL> or <PHONE>, <IP>!", "<CARD>"
    ]


def test_reliable_labelers_are_found():
    # Votes of the first three agree on 900 of 1000 spans; the last one votes at random.
    patterns = {}
    for truth, n in ((1, 600), (-1, 300)):
        for noise in (-1, 1):
            patterns[(truth, truth, truth, noise)] = n // 2
    patterns[(1, 1, -1, 1)], patterns[(-1, -1, 1, -1)] = 50, 50
    reliability, posterior = expectation_maximisation(patterns)
    assert reliability["form"][1][0] > 0.95 and reliability["form"][1][1] < 0.05
    assert abs(reliability["context"][1][0] - reliability["context"][1][1]) < 0.2
    assert posterior[(1, 1, 1, -1)] > 0.95 and posterior[(-1, -1, -1, 1)] < 0.05
    bias, weights = fit_classifier(patterns, posterior)
    score = {p: bias + sum(weights[k][v] for k, v in zip(weights, p, strict=True)) for p in patterns}
    assert all((score[p] > 0) == (posterior[p] > 0.5) for p in patterns)


def test_no_python_on_the_way(spark):
    from zonewright.llm.pii import with_candidates

    plan = with_candidates(table(spark, TEXTS), "text", "c")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    plan = masked(table(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text", ["1." * 30_000, "a@" + "b." * 30_000, "0 " * 30_000, "+" + "1 " * 30_000])
def test_long_runs_end(spark, text):
    assert find_personal_data(table(spark, [text])).count() == 1
