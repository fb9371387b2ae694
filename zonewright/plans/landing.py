"""API responses to landing tables: reshape, look up, encode, upsert."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, functions as F

from zonewright import schemas
from zonewright.functions import collections as C, scalars as S
from zonewright.operators.clean import in_range, require_elements, select_optional, split_quarantine
from zonewright.operators.dedup import keep_first, keep_one
from zonewright.operators.enrich import lookup_join, override_join
from zonewright.operators.nested import encode_nested, nested_list
from zonewright.plans.report import FlowReport, Skipped
from zonewright.session import Staging
from zonewright.sources.dumps import Dumps, ParsedDumps
from zonewright.sources.store import TableStore

# Fixed values.
WINDOW_DAYS = 7
BILLED_ACTORS = 5
COMMENTS_PER_VIDEO = 5
_WANTED = "__wanted"
PROVIDER = (
    "array<struct<logo_path:string,provider_id:int,provider_name:string,display_priority:int>>"
)


def discovered_movies(
    dumps: Dumps, as_of: date, days: int = WINDOW_DAYS, region: str | None = None
) -> DataFrame:
    """Movies of all discover pages released in the window, one row per id, in the
    most popular form."""
    found = dumps.read("discover").select(F.inline("results"))
    window = in_range(
        found,
        "release_date",
        S.window_start(as_of, days).cast("string"),
        F.lit(str(as_of)),
        {"region": region} if region else None,
    )
    movies = window.withColumnRenamed("id", "tmdb_id").dropna(subset=["tmdb_id"])
    return keep_one(movies, ["tmdb_id"], [F.desc_nulls_last("popularity")])


def narrowed(
    responses: DataFrame, wanted: DataFrame, on: list[str], *, for_skewed_join: bool = False
) -> DataFrame:
    """The responses of wanted ids. Dumps only grow, and a run wants the ids of a few days:
    so the rest goes before anything is sorted or gathered. Null ids are not wanted.

    ``for_skewed_join`` is for a lookup join whose left side is not known to be unique: ids meet as a
    struct, by which that join reduces its right side, so that both share one shuffle."""
    if not for_skewed_join:
        return responses.join(wanted.select(*on), on, "left_semi")
    ids = wanted.dropna(subset=on).select(F.struct(*on).alias(_WANTED))
    return responses.dropna(subset=on).join(ids, F.struct(*on) == F.col(_WANTED), "left_semi")


# Stores a frame that is used several times; ``as_it_is`` plans it anew each time.
Keep = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def credit_lists(dumps: Dumps) -> DataFrame:
    """First billed actors, then the director where there is one."""
    actors = C.pick_fields(
        C.below_rank(F.coalesce("cast", F.array()), "order", BILLED_ACTORS),
        {"id": "id", "role": F.lit("Acting"), "character": "character", "name": "name"},
    )
    lead = C.first_where(
        F.col("crew"), lambda c: (c["job"] == "Director") & (c["department"] == "Directing")
    )
    director = F.when(
        lead.isNotNull(),
        F.struct(
            lead["id"].alias("id"),
            F.lit("Director").alias("role"),
            F.lit(None).cast("string").alias("character"),
            lead["name"].alias("name"),
        ),
    )
    return dumps.read("credits").select(
        F.col("id").alias("tmdb_id"),
        C.append_present(
            actors.cast(schemas.CREDITS), director.cast("struct<id:int,role:string,character:string,name:string>")
        ).alias("credits"),
    )


def enriched_movies(movies: DataFrame, dumps: Dumps) -> DataFrame:
    """Movies with credits, reviews, translations, keywords and details. Missing
    lists are empty; a movie's details win over what discover said."""
    lists = {
        "credits": credit_lists(dumps),
        "reviews": dumps.read("reviews").select(
            F.col("id").alias("tmdb_id"), F.col("results").alias("reviews")
        ),
        "languages": dumps.read("translations").select(
            F.col("id").alias("tmdb_id"),
            C.pick_fields(
                F.col("translations"),
                {
                    "iso_639_1": "iso_639_1",
                    "iso_3166_1": "iso_3166_1",
                    "name": "name",
                    "overview": "data.overview",
                    "tagline": "data.tagline",
                },
            ).alias("languages"),
        ),
        "keywords": dumps.read("keywords").select(F.col("id").alias("tmdb_id"), "keywords"),
    }
    rows = movies
    for frame in lists.values():
        rows = lookup_join(rows, narrowed(frame, movies, ["tmdb_id"]), ["tmdb_id"], left_unique=True)
    details = narrowed(dumps.read("details").withColumnRenamed("id", "tmdb_id"), movies, ["tmdb_id"])
    rows = override_join(rows, details, ["tmdb_id"], left_unique=True)
    rows = rows.withColumns(
        {
            name: C.or_empty(F.col(name), schemas.MOVIE_FIELDS[name])
            for name in [*lists, "genres", "origin_country"]
        }
    )
    return select_optional(rows, schemas.MOVIE_FIELDS, strict=True)


def answered_ids(movies: DataFrame, dumps: Dumps, keep: Keep = as_it_is) -> DataFrame:
    """What the id search and the details say of every movie, nulls where nothing."""
    wanted = movies.select(F.col("tmdb_id").alias("movie_tmdb_id"))
    search = dumps.read("id_search").select(
        F.col("tmdb_id").alias("movie_tmdb_id"),
        C.path(
            C.first_where(F.col("results"), lambda r: r["type"] == "movie"), "movie.ids.trakt"
        ).alias("found_id"),
    )
    details = dumps.read("id_details").select(
        F.col("ids.trakt").alias("found_id"),
        "title",
        "trailer",
        F.col("ids.tmdb").alias("tmdb_id"),
        F.col("ids.trakt").alias("trakt_id"),
        F.col("ids.slug").alias("slug"),
        F.col("ids.imdb").alias("imdb_id"),
    )
    searched = keep(
        lookup_join(
            wanted, narrowed(search, wanted, ["movie_tmdb_id"]), ["movie_tmdb_id"], left_unique=True
        )
    )
    return lookup_join(searched, narrowed(details, searched, ["found_id"], for_skewed_join=True), ["found_id"])


def split_ids(answered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Id and trailer of every movie, and the movies none was found for."""
    found, missing = split_quarantine(
        answered,
        {
            "no movie among the search results": F.col("found_id").isNull(),
            "no details for the id": F.col("trakt_id").isNull(),
        },
    )
    ids = found.select("title", "trailer", "tmdb_id", "trakt_id", "slug", "imdb_id")
    return (
        keep_one(ids, ["trakt_id"]),
        missing.select(F.col("movie_tmdb_id").alias("tmdb_id"), "reject_reason"),
    )


def movie_ids(movies: DataFrame, dumps: Dumps) -> tuple[DataFrame, DataFrame]:
    """Id and trailer of every movie, and the movies none was found for."""
    return split_ids(answered_ids(movies, dumps))


def movie_ratings(ids: DataFrame, dumps: Dumps) -> DataFrame:
    """Ratings of every movie with a rating id; ids without an answer drop out."""
    wanted = ids.filter(S.is_filled(F.col("imdb_id"))).select("imdb_id").distinct()
    renamed = dumps.read("ratings").select(
        F.col("Title").alias("title"),
        F.col("Poster").alias("poster"),
        F.col("Awards").alias("awards"),
        F.col("Ratings").alias("ratings"),
        F.col("Metascore").alias("metascore"),
        F.col("imdbRating").alias("imdb_rating"),
        F.col("imdbVotes").alias("imdb_votes"),
        F.col("imdbID").alias("imdb_id"),
    )
    ours = narrowed(renamed, wanted, ["imdb_id"])
    return lookup_join(wanted, ours, ["imdb_id"], "inner", left_unique=True).select(
        *renamed.columns
    )


def movie_providers(ids: DataFrame, dumps: Dumps, region: str) -> DataFrame:
    """Providers of one region, of all kinds, as one list; empty lists drop out."""
    wanted = ids.select("tmdb_id").dropna().distinct()
    # only one text per movie takes part in the join; it is unnested after it
    offers = dumps.read("providers").select(
        F.col("id").alias("tmdb_id"),
        nested_list(
            F.col("results"), PROVIDER, outer_key=region, skip=["link"], key_name="provider_type"
        ).alias("providers"),
    )
    ours = narrowed(offers, wanted, ["tmdb_id"])
    rows = lookup_join(wanted, ours, ["tmdb_id"], "inner", left_unique=True)
    return require_elements(rows, "providers")


def video_comments(
    dumps: Dumps, wanted: DataFrame | None = None, count: int = COMMENTS_PER_VIDEO
) -> DataFrame:
    """The first comments of each video (of the ``wanted`` ones) over all its pages. Rows are cut to
    ``count`` per video before any is gathered."""
    pages = dumps.read("video_comments").select("video_id", "page", "items")
    if wanted is not None:
        pages = narrowed(pages, wanted, ["video_id"])
    entries = pages.select("video_id", "page", F.posexplode("items").alias("position", "item"))
    snippet = F.col("item.snippet.topLevelComment.snippet")
    flat = entries.select(
        "video_id",
        "page",
        "position",
        snippet["authorDisplayName"].alias("author"),
        snippet["textDisplay"].alias("text"),
        snippet["likeCount"].alias("likes"),
        snippet["publishedAt"].alias("published_at"),
    )
    first = keep_first(
        flat.dropna(subset=["video_id"]), ["video_id"], [F.asc("page"), F.asc("position")], count
    )
    gathered = first.groupBy("video_id").agg(
        F.array_sort(
            F.collect_list(F.struct("page", "position", "author", "text", "likes", "published_at"))
        ).alias("entries")
    )
    fields = {n: n for n in ("author", "text", "likes", "published_at")}
    return gathered.select("video_id", C.pick_fields(F.col("entries"), fields).alias("comments"))


def trailer_stats(ids: DataFrame, dumps: Dumps, keep: Keep = as_it_is) -> DataFrame:
    """Statistics and first comments of each movie's trailer. The video comes from
    the trailer URL, or from a search by title where there is no trailer; movies
    with neither drop out. Missing statistics count as zeros.

    Statistics and comments of other videos go before anything is ranked or gathered."""
    search = dumps.read("video_search").select(
        "title", C.path(F.get("items", F.lit(0)), "id.videoId").alias("searched_id")
    )
    movies = keep_one(
        ids.select("tmdb_id", "title", "trailer").dropna(subset=["tmdb_id"]), ["tmdb_id"]
    )
    untold = movies.filter(~F.coalesce(S.is_filled(F.col("trailer")), F.lit(False)))
    videos = lookup_join(movies, narrowed(search, untold, ["title"], for_skewed_join=True), ["title"]).select(
        "tmdb_id",
        F.when(S.is_filled(F.col("trailer")), S.url_parameter(F.col("trailer")))
        .otherwise(F.col("searched_id"))
        .alias("video_id"),
    )
    videos = keep(videos.filter(S.is_filled(F.col("video_id"))))
    wanted = videos.select("video_id").distinct()
    stats = dumps.read("video_stats").select(
        F.col("id").alias("video_id"), F.get("items", F.lit(0))["statistics"].alias("statistics")
    )
    rows = lookup_join(videos, narrowed(stats, wanted, ["video_id"], for_skewed_join=True), ["video_id"])
    rows = lookup_join(rows, video_comments(dumps, wanted), ["video_id"])
    zero = F.struct(
        *[F.lit("0").alias(n) for n in ("viewCount", "likeCount", "commentCount")]
    )
    return rows.select(
        "tmdb_id",
        F.coalesce("statistics", zero).alias("statistics"),
        C.or_empty(F.col("comments"), schemas.COMMENTS).alias("comments"),
        S.video_url(F.col("video_id")).alias("trailer_url"),
    )


def build_landing(
    dumps: Dumps,
    store: TableStore,
    as_of: date,
    *,
    days: int = WINDOW_DAYS,
    region: str = "ES",
    discover_region: str | None = None,
) -> FlowReport:
    """Upsert the five landing tables. Ratings, providers and statistics are
    refreshed for all movies known so far, not only the new ones. Movies without
    ids and lines that are no JSON go to ``rejects`` tables."""
    report = FlowReport()
    keys = schemas.LANDING_KEYS | {
        "rejects/movie_ids": ["tmdb_id"],
        "rejects/responses": ["kind", "line"],
    }

    def load(frames: dict[str, Callable[[], DataFrame]]) -> None:
        def step(table: str, frame: Callable[[], DataFrame]) -> int:
            return store.upsert(table, encode_nested(frame()), keys[table])

        report.run_all(store.spark, {t: partial(step, t, f) for t, f in frames.items()})

    staging = Staging(store.spark, "landing")
    try:
        _load_landing(dumps.parsed_once(staging), store, as_of, days, region, discover_region, report, staging, load)
    finally:
        staging.clear()
    return report


def _load_landing(
    dumps: ParsedDumps,
    store: TableStore,
    as_of: date,
    days: int,
    region: str,
    discover_region: str | None,
    report: FlowReport,
    staging: Staging,
    load: Callable[[dict[str, Callable[[], DataFrame]]], None],
) -> None:
    staged: dict[str, DataFrame] = {}

    def stage(name: str, frame: Callable[[], DataFrame]) -> None:
        """Frames several tables need; one that fails is reported like a table."""

        def step() -> int:
            staged[name] = staging.put(frame())
            return 0

        report.run(f"staged/{name}", step)

    def needed(name: str) -> DataFrame:
        if name not in staged:
            raise Skipped(f"staged/{name} is not there")
        return staged[name]

    stage("movies", lambda: discovered_movies(dumps, as_of, days, discover_region))
    stage("answers", lambda: answered_ids(needed("movies"), dumps, staging.put))
    load(
        {
            "tmdb/movies_released": lambda: enriched_movies(needed("movies"), dumps),
            "trakt/movie_ids_and_trailer": lambda: split_ids(needed("answers"))[0],
            "rejects/movie_ids": lambda: split_ids(needed("answers"))[1],
            "rejects/responses": dumps.unreadable,
        }
    )

    def known() -> DataFrame:
        if not store.exists("trakt/movie_ids_and_trailer"):
            raise Skipped("trakt/movie_ids_and_trailer is not there")
        return store.read("trakt/movie_ids_and_trailer")

    load(
        {
            "omdb/movie_ratings": lambda: movie_ratings(known(), dumps),
            "tmdb/movies_providers": lambda: movie_providers(known(), dumps, region),
            "youtube/trailer_video_stats": lambda: trailer_stats(known(), dumps, staging.put),
        }
    )
