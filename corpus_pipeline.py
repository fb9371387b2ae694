"""A corpus from ``documents``: toxic texts out, one of each group of near-duplicates, personal data
masked, sources mixed to their weights, and what is left packed into sequences.

Every stage takes ``(spark, docs, folder)``, works on all rows of ``docs`` and returns a frame that
is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonewright.llm.common import read_table, ship_package
from zonewright.llm.mixing import remixed
from zonewright.llm.neardup import without_near_duplicates
from zonewright.llm.packing import packed_documents
from zonewright.llm.pii import masked
from zonewright.llm.queries import vocabulary
from zonewright.llm.toxicity import fit_on, without_toxic
from zonewright.session import work_folder

# How often a document of a small source may be taken at most.
MAX_REPEATS = 1.5


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It is fitted on labelled rows of ``docs``. Null and
    empty texts have the score of no words; rows that repeat are judged each; null keys are judged and
    never learnt from; without labels of both classes, or without rows, all that is there has one score."""
    return without_toxic(docs, fit_on(docs, read_table(spark, folder, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Spans of personal data become their kind in angle brackets; all documents stay. The column
    ``n_chars`` is carried along as it came."""
    return masked(docs)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document stays; those of small sources are repeated up to ``MAX_REPEATS`` times on average,
    those of sources without any token are taken once."""
    return remixed(docs, max_repeats=MAX_REPEATS)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents, with their sequences. A null or empty text is its end token only; rows
    that repeat are documents each, null keys too; no rows give no pieces."""
    return packed_documents(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

# No SQL trains the classifiers or packs sequences; tests hold the stages against other versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, for the documents in ``sf_dir``."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{work_folder(spark, f'pipeline-{name}')}/docs"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
