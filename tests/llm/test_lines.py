import random

import pytest

from zonewright.llm.lines import deduplicated_lines

SCHEMA = "doc_id long, text string, lost string, n_lines string, line string, first int"
BLANKS = " \t\n\v\f\r"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", 1) for i, t in rows], SCHEMA)


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, documents=2, least=10):
    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key_of(line)) >= least:
                    holders.setdefault(key_of(line), set()).add(i)
    first = {k: min(h) for k, h in holders.items() if len(h) >= documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or first.get(key_of(x), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["text"], r["_n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("documents", [2, 3])
def test_lines_stay_in_the_first_document(spark, documents):
    rng = random.Random(documents)
    pool = [f"Shared line number {i}" for i in range(30)] + ["short", "", "  ", "ÄÖÜ line with ß in it"]
    rows = []
    for i in rng.sample(range(-50, 500), 120):
        lines = [rng.choice(["", " ", "\t", "\r"]) + rng.choice([str.upper, str.lower, str])(rng.choice(pool)) for _ in range(rng.randrange(12))]
        rows.append((i, "\n".join([*lines, f"own line of document {i}"])))
    df = deduplicated_lines(table(spark, rows), documents=documents)
    assert df.columns == ["doc_id", "text", "lost", "n_lines", "line", "first", "_n_lines", "n_dropped"]
    assert got(df) == brute(rows, documents)


def test_odd_rows(spark):
    line = "a line that is long enough"
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (None, line), (None, line), (4, f"{line}\n{line}\nx"), (4, f"{line}\n{line}\nx"), (4, f"z\n{line}"),
        (5, f"{line} \n \x0b{line.upper()}"), (6, line), (7, "nine char"), (8, "nine char"), (9, "ten chars!"), (10, "TEN CHARS!"),
        (11, "Ärger im Haus"), (12, "ärger im Haus"), (13, "no-break ends "), (14, "no-break ends"),
    ]
    assert got(deduplicated_lines(table(spark, rows))) == brute(rows)


def test_very_long_texts(spark):
    rows = [(i, "\n".join(f"line {j} of a long text" for j in range(i, 60_000 + i))) for i in range(3)] + [(9, "w" * 3_000_000)]
    assert got(deduplicated_lines(table(spark, rows))) == brute(rows)


def test_no_rows(spark):
    assert deduplicated_lines(table(spark, [])).count() == 0


def test_a_hot_key_and_a_hot_line(spark):
    rows = [(7, f"the one line all have\nown {i % 50} of the texts")  for i in range(3000)] + [(8 + i, "the one line all have") for i in range(3000)]
    assert got(deduplicated_lines(table(spark, rows))) == brute(rows)
