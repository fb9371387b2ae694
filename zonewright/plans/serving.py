"""Trusted tables to serving tables and the searchable vector table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from zonewright import schemas
from zonewright.functions.scalars import item_text
from zonewright.operators.enrich import lookup_join
from zonewright.operators.export import export_rows
from zonewright.operators.vectors import Embedder, embed_texts, query_vector, top_k
from zonewright.plans.report import FlowReport
from zonewright.session import Staging
from zonewright.sources.store import TableStore

VECTORS = "movie_vectors"


def ratings_with_ids(headers: DataFrame, ids: DataFrame) -> DataFrame:
    """Rating headers with the movie id and trailer; no row is lost or multiplied."""
    return lookup_join(headers, ids.select("imdb_id", "tmdb_id", "trailer"), ["imdb_id"])


def external_with_ids(ratings: DataFrame, ids: DataFrame) -> DataFrame:
    return lookup_join(ratings, ids.select("imdb_id", "tmdb_id"), ["imdb_id"])


def serving_frame(trusted: TableStore, table: str) -> DataFrame:
    """One serving table: joined where needed, cut to its columns, made exportable."""
    rows = trusted.read(table)
    if table == "imdb_data":
        rows = ratings_with_ids(rows, trusted.read("movie_ids_and_trailer"))
    if table == "external_ratings":
        rows = external_with_ids(rows, trusted.read("movie_ids_and_trailer"))
        rows = rows.dropna(subset=["tmdb_id"])
    return export_rows(rows, schemas.SERVING_COLUMNS.get(table))


def unmatched_ratings(trusted: TableStore) -> DataFrame:
    """External ratings of no known movie; they have no serving key."""
    rows = external_with_ids(
        trusted.read("external_ratings"), trusted.read("movie_ids_and_trailer")
    )
    return rows.filter(F.col("tmdb_id").isNull()).select("imdb_id", "source", "value")


def movie_items(movies: DataFrame) -> DataFrame:
    """Id, text and metadata of the item that stands for each movie, with a hash of either."""
    text = item_text(F.col("title"), F.col("overview"))
    return movies.select(
        F.col("tmdb_id").cast("string").alias("id"), text.alias("text"), F.struct("*").alias("metadata")
    ).select("id", "text", text_hash(F.col("text")), "metadata", metadata_hash(F.col("metadata")))


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_hash")


def metadata_hash(metadata: Column) -> Column:
    return F.sha2(F.to_json(metadata), 256).alias("metadata_hash")


def refresh_vectors(
    items: DataFrame, store: TableStore, embedder: Embedder, table: str = VECTORS
) -> int:
    """Embed items (``id, text, text_hash, metadata, metadata_hash`` and others) whose text is new
    or changed, and renew changed metadata under the vector an unchanged text already has.

    What is stored meets the items by id. Items that are as they were go no further; of the
    others, only id and text of those without a vector for their text reach the embedder.
    """
    known_columns = {"text_hash": "string", "metadata_hash": "string", "embedding": "array<float>"}
    if store.exists(table):
        known = store.read(table).select("id", *(F.col(c).alias(f"known_{c}") for c in known_columns))
        met = items.join(known, "id", "left")
    else:
        met = items.withColumns({f"known_{c}": F.lit(None).cast(t) for c, t in known_columns.items()})
    same_text = F.col("text_hash").eqNullSafe(F.col("known_text_hash"))
    same = same_text & F.col("metadata_hash").eqNullSafe(F.col("known_metadata_hash"))
    staging = Staging(store.spark, "refresh")
    try:
        changed = staging.put(met.filter(~same))
        vectors = embed_texts(changed.filter(~same_text).select("id", "text"), "id", "text", embedder, out="found")
        renewed = changed.join(vectors, "id", "left").withColumn(
            "embedding", F.when(same_text, F.col("known_embedding")).otherwise(F.col("found"))
        )
        return store.upsert(table, renewed.select(*items.columns, "embedding"), ["id"])
    finally:
        staging.clear()


def search(
    store: TableStore, text: str, embedder: Embedder, k: int = 10, table: str = VECTORS
) -> DataFrame:
    """The ``k`` items nearest to a text, with their metadata, best first."""
    vectors = store.read(table)
    best = top_k(vectors, [("query", query_vector(store.spark, text, embedder))], k)
    found = vectors.select("id", "text", "metadata").join(best, "id")
    return found.select("rank", "id", "score", "text", "metadata").orderBy("rank")


Sink = Callable[[str, DataFrame, list[str]], None]


def build_serving(
    trusted: TableStore,
    serving: TableStore,
    embedder: Embedder | None = None,
    sink: Sink | None = None,
) -> FlowReport:
    """Upsert the sixteen serving tables and, given an embedder, the vectors.

    With a ``sink``, every table that got rows is then handed to it as ``(name, rows,
    keys)``; ``relational_upsert`` and ``index_upsert`` make such sinks. It is part of the
    table's step: a sink that fails is reported, and the next run sends the rows again.
    """
    report = FlowReport()
    steps: dict[str, Callable[[], int]] = {
        table: partial(_write, trusted, serving, table, keys)
        for table, keys in schemas.SERVING_KEYS.items()
    }
    if trusted.exists("external_ratings") and trusted.exists("movie_ids_and_trailer"):
        steps["rejects/external_ratings"] = lambda: serving.upsert(
            "rejects/external_ratings", unmatched_ratings(trusted), ["imdb_id", "source"]
        )
    if embedder is not None and trusted.exists("movies"):
        steps[VECTORS] = lambda: refresh_vectors(
            movie_items(export_rows(trusted.read("movies"))), serving, embedder
        )
    if sink is not None:
        keys = schemas.SERVING_KEYS | {VECTORS: ["id"]}
        steps = {
            table: partial(_send, serving, table, step, keys[table], sink) if table in keys else step
            for table, step in steps.items()
        }
    report.run_all(serving.spark, steps)
    return report


def _send(
    serving: TableStore, table: str, step: Callable[[], int], keys: list[str], sink: Sink
) -> int:
    count = step()
    if count:
        sink(table, serving.read(table), keys)
    return count


def _write(trusted: TableStore, serving: TableStore, table: str, keys: list[str]) -> int:
    if not trusted.exists(table):
        return 0  # nothing has reached the trusted zone yet
    return serving.upsert(table, serving_frame(trusted, table), keys)
