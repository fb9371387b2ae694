"""Lines that repeat across documents: hashed, counted by document, dropped but for one place each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import spare_name, stage

# Code points that a normalised line must have to count, and documents from which on it is dropped.
LEAST_CHARS = 10
DOCUMENTS = 2

# ASCII white space, and the letters whose case does not matter.
_BLANKS = " \t\n\v\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """The lines of a text, an empty one for a null or empty text."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A to Z in lower case."""
    return F.translate(F.trim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def _hash128(*values: Column) -> list[Column]:
    """Two 64-bit hashes: with one, lines of a large corpus would be taken for each other."""
    return [F.xxhash64(F.lit(7), *values), F.xxhash64(F.lit(1_000_003), *values)]


def line_places(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc, t1, t2, pos, h1, h2`` for every line that is long enough, of documents with a key: the
    document, the hash of its text, the line's place in it and the hash of its key."""
    body = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    t1, t2 = _hash128(F.col("text"))
    # The text is hashed before its lines are exploded, once and not for each line.
    whole = body.select("doc", t1.alias("t1"), t2.alias("t2"), F.transform(lines_of(F.col("text")), line_key).alias("lines"))
    each = whole.select("doc", "t1", "t2", F.posexplode("lines").alias("pos", "line"))
    h1, h2 = _hash128(F.col("line"))
    return each.where(F.length("line") >= least_chars).select("doc", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2"))


def repeated_lines(places: DataFrame, *, documents: int = DOCUMENTS) -> DataFrame:
    """``h1, h2, first`` of the lines that are in ``documents`` documents or more: ``first`` is the
    smallest of them."""
    if documents <= 2:
        # Two documents are told by the smallest and the largest: one aggregation, whatever repeats.
        found = places.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    else:
        holders = places.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        found = holders.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where(F.col("n") >= documents)
    return found.select("h1", "h2", "first")


def deduplicated_lines(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    least_chars: int = LEAST_CHARS,
    documents: int = DOCUMENTS,
) -> DataFrame:
    """``docs``, all columns, with ``text`` freed of repeated lines, and ``n_lines`` (before) and
    ``n_dropped`` added (a longer name each if the table has such a column).

    A line's key is the line without white space at its ends and with A to Z in lower case. Keys
    of ``least_chars`` code points and more that ``documents`` documents or more hold lose their lines,
    except all those in the document with the smallest key. Other lines stay as they are, in
    their order. Documents are counted by hashes of lines that carry no text; the text
    itself moves once, to meet the places of the lines it loses.

    A null text is an empty one and has one empty line. Rows that repeat a key are one document when
    documents are counted, and each row keeps or loses its own lines. A null key is no document: its
    row's text stays whole and counts for nothing. No rows give no rows. A text's lines are
    handled together, however many; a line that any share of the rows has is split among tasks.
    """
    places = stage(line_places(docs, text=text, key=key, least_chars=least_chars), "line-places")
    # The lookup side is dealt otherwise than the join deals it, so that a hot line can be split.
    repeated = repeated_lines(places, documents=documents).repartition(F.xxhash64(F.lit("deal"), "h1", "h2"))
    lost = (
        places.join(repeated, ["h1", "h2"])
        .where("doc > first")
        .groupBy("doc", "t1", "t2")
        .agg(F.collect_set("pos").alias("lost"))
        .repartition(F.xxhash64(F.lit("deal"), "doc"))
    )
    t1, t2 = _hash128(F.col(text).cast("string"))
    gone = spare_name(docs, "lost")
    lost = lost.select(F.col("doc").alias(f"{gone}_doc"), F.col("t1").alias(f"{gone}_1"), F.col("t2").alias(f"{gone}_2"), F.col("lost").alias(gone))
    joined = docs.join(lost, (F.col(key) == F.col(f"{gone}_doc")) & (t1 == F.col(f"{gone}_1")) & (t2 == F.col(f"{gone}_2")), "left")
    split, n_lines, n_dropped = (spare_name(docs, n) for n in ("split_lines", "n_lines", "n_dropped"))
    # A set difference over places, not a search for each line: it stays linear in a text's lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    left = F.when(F.col(gone).isNull(), F.col(split)).otherwise(F.transform(stay, lambda i: F.element_at(split, i + 1)))
    return joined.withColumn(split, lines_of(F.col(text))).select(
        *(F.array_join(left, "\n").alias(c) if c == text else F.col(c) for c in docs.columns),
        F.size(split).cast("long").alias(n_lines),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_dropped),
    )
