"""Landing tables to typed, normalized, duplicate-free trusted tables.

Nothing is cached: an output reads its own few landing columns (Parquet prunes the
rest). A list that a dimension and a bridge are made from is parsed and exploded once;
its links are written to the shared folder, and both read them there, so a lost executor
costs only its tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import partial

from pyspark.sql import DataFrame, functions as F

from zonewright import schemas
from zonewright.functions import collections as C, scalars as S
from zonewright.operators.clean import clean_entity, require_castable, require_filled
from zonewright.operators.clean import require_present, recast
from zonewright.operators.dedup import keep_one
from zonewright.operators.metrics import observe_rows
from zonewright.operators.nested import DimAndBridge, child, explode_children, normalize_nested
from zonewright.plans.report import FlowReport, Skipped
from zonewright.session import Staging
from zonewright.sources.store import TableNotFound, TableStore

NESTED = ["credits", "reviews", "genres", "languages", "keywords"]


def clean_movies(landing: DataFrame) -> DataFrame:
    return clean_entity(
        landing,
        key="tmdb_id",
        required_text=["title"],
        text=["overview", "original_language", "original_title", "poster_path", "tagline"],
        numbers=["budget", "revenue", "runtime"],
        iso_date="release_date",
        joined_lists=["origin_country"],
    )


def movies(clean: DataFrame) -> DataFrame:
    return keep_one(clean.drop(*NESTED), ["tmdb_id"])


def people_links(clean: DataFrame) -> DataFrame:
    return explode_children(
        clean,
        ["tmdb_id"],
        "credits",
        schemas.CREDITS,
        {"cast_id": "id", "role": "role", "character": "character", "name": "name"},
    )


def people(links: DataFrame) -> DimAndBridge:
    """Cast members, and who did what in which movie. One person may act in and
    direct the same movie: the role is part of the bridge's key."""
    dim, bridge = normalize_nested(
        links,
        dim_key=["cast_id"],
        dim_columns=["name"],
        required_dim=["name"],
        bridge_key=["tmdb_id", "cast_id", "role"],
        bridge_columns=["character"],
    )
    return DimAndBridge(
        dim, bridge.withColumn("movie_cast_id", S.joined_key("tmdb_id", "cast_id"))
    )


def reviews(clean: DataFrame) -> DataFrame:
    rows = explode_children(
        clean,
        ["tmdb_id"],
        "reviews",
        schemas.REVIEWS,
        {
            "author": "author",
            "content": "content",
            "created_at": S.instant(child("created_at")),
            "url": S.url_or_null(child("url")),
        },
    )
    filled = require_present(require_filled(rows, ["author", "content"]), ["created_at"])
    return keep_one(filled, schemas.TRUSTED_KEYS["reviews"])


def _named_links(clean: DataFrame, column: str, schema: str, id_name: str) -> DataFrame:
    return explode_children(clean, ["tmdb_id"], column, schema, {id_name: "id", "name": "name"})


def genre_links(clean: DataFrame) -> DataFrame:
    return _named_links(clean, "genres", schemas.GENRES, "genre_id")


def genres(links: DataFrame) -> DimAndBridge:
    dim, bridge = normalize_nested(
        links,
        dim_key=["genre_id"],
        dim_columns=["name"],
        bridge_key=["tmdb_id", "genre_id"],
        required=["genre_id", "name"],
    )
    return DimAndBridge(
        dim, bridge.withColumn("movie_genre_id", S.joined_key("tmdb_id", "genre_id"))
    )


def keyword_links(clean: DataFrame) -> DataFrame:
    return _named_links(clean, "keywords", schemas.KEYWORDS, "keyword_id")


def keywords(links: DataFrame) -> DimAndBridge:
    dim, bridge = normalize_nested(
        links,
        dim_key=["keyword_id"],
        dim_columns=["name"],
        bridge_key=["tmdb_id", "keyword_id"],
        required=["keyword_id", "name"],
    )
    return DimAndBridge(
        dim, bridge.withColumn("movie_keyword_id", S.joined_key("tmdb_id", "keyword_id"))
    )


def language_links(clean: DataFrame) -> DataFrame:
    return explode_children(
        clean,
        ["tmdb_id"],
        "languages",
        schemas.LANGUAGES,
        {"iso_639_1": "iso_639_1", "iso_3166_1": "iso_3166_1", "name": "name"},
    )


def languages(links: DataFrame) -> DimAndBridge:
    dim, bridge = normalize_nested(
        require_filled(links, ["iso_639_1", "name"]),
        dim_key=["iso_639_1"],
        dim_columns=["iso_3166_1", "name"],
        bridge_key=["tmdb_id", "iso_639_1"],
    )
    return DimAndBridge(
        dim, bridge.withColumn("movie_language_id", S.joined_key("tmdb_id", "iso_639_1"))
    )


def provider_links(landing: DataFrame) -> DataFrame:
    return explode_children(
        require_castable(landing, "tmdb_id"),
        ["tmdb_id"],
        "providers",
        schemas.PROVIDERS,
        {
            "provider_id": "provider_id",
            "provider_name": "provider_name",
            "logo_path": "logo_path",
            "display_priority": "display_priority",
            "provider_type": "provider_type",
        },
    )


def providers(links: DataFrame) -> DimAndBridge:
    dim, bridge = normalize_nested(
        links,
        dim_key=["provider_id"],
        dim_columns=["provider_name", "logo_path", "display_priority"],
        dim_order=[F.asc_nulls_last("display_priority")],
        bridge_key=["tmdb_id", "provider_id", "provider_type"],
    )
    key = S.joined_key("tmdb_id", "provider_id", "provider_type")
    return DimAndBridge(dim, bridge.withColumn("movie_provider_id", key))


def movie_ids(landing: DataFrame) -> DataFrame:
    typed = recast(
        require_castable(landing, "tmdb_id"),
        {
            "title": "string",
            "trailer": "string",
            "trakt_id": "int",
            "slug": "string",
            "imdb_id": "string",
        },
    )
    return keep_one(typed, ["tmdb_id"], [F.asc_nulls_last("trakt_id")])


def rating_headers(landing: DataFrame) -> DataFrame:
    rows = landing.select(
        F.col("imdb_id").cast("string").alias("imdb_id"),
        S.amount_text(F.col("imdb_rating")).alias("imdb_rating"),
        S.grouped_number(F.col("imdb_votes")).alias("imdb_votes"),
        S.whole_number(F.col("metascore")).alias("metascore"),
        F.col("awards").cast("string").alias("awards"),
        F.col("poster").cast("string").alias("poster"),
    )
    return keep_one(require_present(rows, ["imdb_id"]), ["imdb_id"])


def external_ratings(landing: DataFrame) -> DataFrame:
    rows = explode_children(
        require_present(landing, ["imdb_id"]),
        ["imdb_id"],
        "ratings",
        schemas.RATINGS,
        {"source": "Source", "value": "Value"},
    )
    unique = keep_one(require_filled(rows, ["source", "value"]), ["imdb_id", "source"])
    return unique.withColumn("rating_id", S.joined_key("imdb_id", "source"))


def video_statistics(landing: DataFrame) -> DataFrame:
    # As the only element of a list, the text is parsed once and not for each of its fields.
    statistics = F.array(C.parse_json(F.col("statistics"), schemas.STATISTICS))
    rows = require_castable(landing, "tmdb_id").select("tmdb_id", F.inline(statistics)).select(
        "tmdb_id",
        S.grouped_number(F.col("viewCount")).alias("views"),
        S.grouped_number(F.col("likeCount")).alias("likes"),
        S.grouped_number(F.col("commentCount")).alias("comments"),
    )
    return keep_one(rows, ["tmdb_id"], [F.desc_nulls_last("views")])


def video_comments(landing: DataFrame) -> DataFrame:
    rows = explode_children(
        require_castable(landing, "tmdb_id"),
        ["tmdb_id"],
        "comments",
        schemas.COMMENTS,
        {
            "author": "author",
            "text": "text",
            "likes": "likes",
            "published_at": S.instant(child("published_at")),
        },
    )
    present = require_present(rows, ["author", "text", "published_at"])
    return keep_one(present, schemas.TRUSTED_KEYS["youtube_comments"])


# Lists that become a dimension and a bridge: how links are taken, how they are split, both tables.
NORMALIZED: dict[str, tuple[Callable, Callable, tuple[str, str]]] = {
    "credits": (people_links, people, ("cast", "movies_cast")),
    "genres": (genre_links, genres, ("genres", "movies_genres")),
    "languages": (language_links, languages, ("languages", "movies_languages")),
    "keywords": (keyword_links, keywords, ("keywords", "movies_keywords")),
    "providers": (provider_links, providers, ("providers", "movies_providers")),
}


def trusted_frames(
    landing: Callable[[str], DataFrame], links: Callable[[str], DataFrame] | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """Every trusted table by name, each built only when called. ``links`` gives the links of a list
    that have been taken already; without it every table takes its own."""

    def clean() -> DataFrame:
        return clean_movies(landing("tmdb/movies_released"))

    taken = links or (lambda name: list_links(landing, name))
    frames: dict[str, Callable[[], DataFrame]] = {"movies": lambda: movies(clean())}
    for name, (_, split, (dim, bridge)) in NORMALIZED.items():
        frames[dim] = partial(lambda f, n: f(taken(n)).dim, split, name)
        frames[bridge] = partial(lambda f, n: f(taken(n)).bridge, split, name)
    frames["reviews"] = lambda: reviews(clean())
    frames["movie_ids_and_trailer"] = lambda: movie_ids(landing("trakt/movie_ids_and_trailer"))
    frames["imdb_data"] = lambda: rating_headers(landing("omdb/movie_ratings"))
    frames["external_ratings"] = lambda: external_ratings(landing("omdb/movie_ratings"))
    frames["youtube_statistics"] = lambda: video_statistics(landing("youtube/trailer_video_stats"))
    frames["youtube_comments"] = lambda: video_comments(landing("youtube/trailer_video_stats"))
    return frames


def list_links(landing: Callable[[str], DataFrame], name: str) -> DataFrame:
    """The exploded links of one list of ``NORMALIZED``."""
    take = NORMALIZED[name][0]
    if name == "providers":
        return take(landing("tmdb/movies_providers"))
    return take(clean_movies(landing("tmdb/movies_released")))


def build_trusted(source: TableStore, target: TableStore) -> FlowReport:
    """Upsert the seventeen trusted tables. Rows before and after cleaning are
    counted while the movies table is written."""
    report = FlowReport()
    staging = Staging(target.spark, "trusted")
    staged: dict[str, DataFrame] = {}

    def stage(name: str) -> int:
        with suppress(TableNotFound):  # its landing table has never received a row
            staged[name] = staging.put(list_links(source.read, name))
        return 0

    def links(name: str) -> DataFrame:
        if name not in staged:
            list_links(source.read, name)  # raises what it has raised before
            raise Skipped(f"staged/{name} is not there")
        return staged[name]

    frames = trusted_frames(source.read, links)

    def write_movies() -> int:
        read, before = observe_rows(source.read("tmdb/movies_released"), "movies_read")
        kept, after = observe_rows(clean_movies(read), "movies_kept")
        rows = target.upsert("movies", movies(kept), schemas.TRUSTED_KEYS["movies"])
        report.metrics.update(movies_read=before.get["rows"], movies_kept=after.get["rows"])
        return rows

    steps = {
        table: partial(_write, target, table, frames[table], keys)
        for table, keys in schemas.TRUSTED_KEYS.items()
    }
    try:
        report.run_all(target.spark, {f"staged/{name}": partial(stage, name) for name in NORMALIZED})
        report.run_all(target.spark, steps | {"movies": write_movies})
    finally:
        staging.clear()
    return report


def _write(target: TableStore, table: str, frame: Callable[[], DataFrame], keys: list[str]) -> int:
    try:
        rows = frame()
    except TableNotFound:
        return 0  # its landing table has never received a row
    return target.upsert(table, rows, keys)
