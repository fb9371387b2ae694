"""The three zone flows over API responses that are derived from the test tables.

Every order stands for a movie. Its responses are made from its own columns, with
blanks, odd dates, missing answers and the like laid in by order status and
priority; video statistics come from events, comment pages from conversations.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonewright import schemas
from zonewright.catalog.registry import query, table
from zonewright.functions.embedding import FeatureHashing
from zonewright.operators.export import export_rows
from zonewright.plans.landing import build_landing
from zonewright.plans.report import FlowReport
from zonewright.plans.serving import build_serving
from zonewright.plans.trusted import build_trusted
from zonewright.session import work_folder
from zonewright.sources.dumps import Dumps
from zonewright.sources.files import Files
from zonewright.sources.store import TableStore

AS_OF = date(2001, 8, 1)
WINDOW = 2_500


def _lit(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _object(**fields: object) -> Column:
    return F.struct(*[_lit(v).alias(k) for k, v in fields.items()])


def lay_dumps(spark: SparkSession, folder: str, root: str) -> Dumps:
    """Write every response the flows read."""
    dumps = Dumps(spark, root)
    orders = table(spark, folder, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    order_key, customer = F.col("o_orderkey"), F.col("o_custkey")
    movie, digit = order_key + 1, F.substring(priority, 1, 1).cast("int")
    name = F.concat(F.lit("Order "), order_key.cast("string"))
    title = F.when(priority == "5-LOW", F.lit("")).otherwise(name)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    released = F.when(
        (status == "P") & (priority == "1-URGENT"), F.date_format("o_orderdate", "yyyy/MM/dd")
    ).otherwise(day)

    documents: dict[str, DataFrame] = {}

    def write(kind: str, rows: DataFrame, **fields: object) -> None:
        documents[kind] = rows.select(*[_lit(v).alias(k) for k, v in fields.items()])

    found = _object(
        id=movie,
        title=title,
        overview=priority,
        genre_ids=F.array(digit),
        release_date=released,
        poster_path="/p.jpg",
        popularity=F.col("o_totalprice"),
        region="ES",
    )
    broken = found.withField("id", F.lit(None).cast("bigint"))
    write("discover", orders, page=1, total_pages=1, results=F.array(found, broken))

    def person(number: Column, label: str, order: int, character: object = None) -> Column:
        return _object(
            id=number.cast("int"),
            name=F.concat(F.lit(f"{label} "), customer.cast("string")),
            character=_lit(character).cast("string"),
            order=order,
        )

    boss = _object(
        id=F.when(status == "F", customer + 1).otherwise(customer + 2_000_001).cast("int"),
        name=F.concat(F.lit("Boss "), customer.cast("string")),
        job=F.when(status == "O", F.lit("Writer")).otherwise(F.lit("Director")),
        department="Directing",
    )
    write(
        "credits",
        orders,
        id=movie,
        cast=F.array(
            person(customer + 1, "Customer", 0, priority),
            person(F.lit(None), "Nobody", 1),
            person(customer + 1_000_001, "Extra", 7),
        ),
        crew=F.array(boss),
    )
    review = _object(
        author=F.when(status == "P", F.lit("")).otherwise(F.concat(F.lit("a"), customer.cast("string"))),
        content=priority,
        created_at=F.when(priority == "2-HIGH", F.lit("last week"))
        .when(priority == "1-URGENT", F.concat(day, F.lit("T10:00:00+02:00")))
        .otherwise(F.concat(day, F.lit("T10:00:00.000Z"))),
        url=F.when(status == "F", F.lit("https://reviews.example/1")).otherwise(F.lit("www.x")),
    )
    write("reviews", orders, id=movie, results=F.array(review, review))
    texts = _object(overview="o", tagline="t")
    write(
        "translations",
        orders,
        id=movie,
        translations=F.array(
            _object(iso_639_1="en", iso_3166_1="US", name="English", data=texts),
            _object(
                iso_639_1=F.lower(status),
                iso_3166_1="XX",
                name=F.when(status == "P", F.lit("")).otherwise(F.concat(F.lit("Lang "), status)),
                data=texts,
            ),
        ),
    )
    write(
        "keywords",
        orders,
        id=movie,
        keywords=F.array(
            _object(id=digit, name=priority), _object(id=F.lit(None).cast("int"), name=F.lit("x"))
        ),
    )
    write(
        "details",
        orders.filter(~((status == "O") & (priority == "2-HIGH"))),
        id=movie,
        title=title,
        overview=F.when(priority != "3-MEDIUM", priority),
        original_language="en",
        original_title=name,
        release_date=released,
        genres=F.array(
            _object(id=F.ascii(status), name=status), _object(id=digit + 10, name=priority)
        ),
        budget=F.col("o_totalprice").cast("bigint"),
        runtime=90,
        tagline="",
        origin_country=F.array(F.lit("US"), status),
    )
    offer = _object(
        logo_path="/l.png",
        provider_id=digit,
        provider_name=F.concat(F.lit("Shop "), priority),
        display_priority=F.ascii(status),
    )
    region = _object(link="https://offers.example", flatrate=F.array(offer), rent=F.array(offer))
    abroad = _object(link="https://offers.example", buy=F.array(offer))
    offers = _object(ES=F.when(status != "P", region), US=abroad)
    write("providers", orders, id=movie, results=offers)
    known = F.struct(
        (movie + 1_000_000).alias("trakt"),
        F.concat(F.lit("order-"), order_key.cast("string")).alias("slug"),
        movie.alias("tmdb"),
        F.when(priority != "3-MEDIUM", F.concat(F.lit("tt"), order_key.cast("string"))).alias("imdb"),
    )
    hit = _object(type="movie", score=1.0, movie=_object(title=name, ids=known))
    other = _object(type="show", score=2.0, movie=_object(title=name, ids=known))
    write(
        "id_search",
        orders,
        tmdb_id=movie,
        results=F.when((status == "P") & (priority == "2-HIGH"), F.array(other)).otherwise(
            F.array(other, hit)
        ),
    )
    video = F.concat(F.lit("v"), order_key.cast("string"))
    write(
        "id_details",
        orders.filter(~((status == "P") & (priority == "4-NOT SPECIFIED"))),
        title=name,
        trailer=F.when(status == "F", F.concat(F.lit("https://youtube.com/watch?v="), video, F.lit("&t=1")))
        .when(status == "P", F.concat(F.lit("https://youtu.be/"), video)),
        ids=known,
    )
    write(
        "ratings",
        orders.filter(status != "P"),
        Title=name,
        Poster="N/A",
        Awards=priority,
        Ratings=F.array(
            _object(Source="IMDb", Value="8.7/10"),
            _object(Source="RT", Value=F.when(status == "F", F.lit("")).otherwise(F.lit("90%"))),
        ),
        Metascore=F.when(status == "F", F.lit("N/A")).otherwise(F.lit("73")),
        imdbRating="8.7",
        imdbVotes=F.format_number(F.col("o_totalprice").cast("bigint"), 0),
        imdbID=F.concat(F.lit("tt"), order_key.cast("string")),
    )
    result = F.array(
        _object(id=_object(videoId=F.concat(F.lit("s"), order_key.cast("string"))))
    )
    write(
        "video_search",
        orders,
        title=name,
        items=F.when(priority == "1-URGENT", F.slice(result, 1, 0)).otherwise(result),
    )
    counts = F.array(
        _object(
            statistics=_object(
                viewCount=(F.round(F.col("value") * 100).cast("bigint") * 1_000_000).cast("string"),
                likeCount=F.col("user_id").cast("string"),
                commentCount="n/a",
            )
        )
    )
    write(
        "video_stats",
        table(spark, folder, "events"),
        id=F.concat(F.lit("v"), F.col("event_id").cast("string")),
        items=F.when(F.col("event_type") == "error", F.slice(counts, 1, 0)).otherwise(counts),
    )
    minute = F.make_interval(mins=F.col("turn").cast("int"))
    posted = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minute
    comment = _object(
        authorDisplayName=F.col("role"),
        textDisplay=F.col("text"),
        likeCount=F.col("turn").cast("int"),
        publishedAt=F.when(F.col("role") == "system", F.lit("soon")).otherwise(
            F.date_format(posted, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ),
    )
    item = _object(snippet=_object(topLevelComment=_object(snippet=comment)))
    write(
        "video_comments",
        table(spark, folder, "conversations"),
        video_id=F.concat(F.lit("v"), F.col("conv_id").cast("string")),
        page=F.col("turn"),
        items=F.array(item),
    )

    def lay(kind: str) -> int:
        dumps.write(kind, documents[kind])
        return 0

    report = FlowReport()
    report.run_all(spark, {kind: partial(lay, kind) for kind in documents})
    report.finish()
    return dumps


class Zones:
    """The zones below one root, built on first use, each from the one before."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.root = work_folder(spark, "zones")
        self._dumps: Dumps | None = None
        self._built: dict[str, TableStore] = {}

    def dumps(self) -> Dumps:
        if self._dumps is None:
            self._dumps = lay_dumps(self.spark, self.folder, f"{self.root}/dumps")
        return self._dumps

    def landing(self) -> TableStore:
        def build(store: TableStore) -> None:
            build_landing(self.dumps(), store, AS_OF, days=WINDOW, discover_region="ES").finish()

        return self._zone("landing", build)

    def trusted(self) -> TableStore:
        return self._zone("trusted", lambda s: build_trusted(self.landing(), s).finish())

    def serving(self) -> TableStore:
        return self._zone(
            "serving", lambda s: build_serving(self.trusted(), s, FeatureHashing(64)).finish()
        )

    def _zone(self, name: str, build) -> TableStore:
        if name not in self._built:
            store = TableStore(self.spark, f"{self.root}/{name}")
            build(store)
            self._built[name] = store
        return self._built[name]


_ZONES: dict[tuple[str, str], Zones] = {}


def zones(spark: SparkSession, folder: str) -> Zones:
    """One set of zones per application and state of the input files."""
    inputs = [f"{folder}/{name}.parquet" for name in ("orders", "events", "conversations")]
    key = (spark.sparkContext.applicationId, Files(spark).stamp(inputs))
    if key not in _ZONES:
        _ZONES[key] = Zones(spark, folder)
    return _ZONES[key]


def table_counts(store: TableStore, names: list[str]) -> DataFrame:
    """Rows ``(table_name, n)``. Counts come from file footers where a table has no
    pending changes."""
    counts = [
        store.read(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in names
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


# The orders that reach each table, by the same rules, as one SQL prefix.
_BASE = """
    WITH seen AS (
      SELECT *, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
                     THEN strftime(o_orderdate, '%Y/%m/%d')
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END AS released,
             o_orderstatus AS st, o_orderpriority AS pr
      FROM orders),
    discovered AS (
      SELECT * FROM seen
      WHERE released BETWEEN strftime(DATE '2001-08-01' - 2500, '%Y-%m-%d') AND '2001-08-01'),
    found AS (
      SELECT * FROM discovered WHERE NOT (st = 'P' AND pr IN ('2-HIGH', '4-NOT SPECIFIED'))),
    rated AS (SELECT * FROM found WHERE pr <> '3-MEDIUM' AND st <> 'P'),
    trailers AS (
      SELECT *, CASE st WHEN 'F' THEN 'v' || o_orderkey ELSE 's' || o_orderkey END AS video
      FROM found WHERE st = 'F' OR (st = 'O' AND pr <> '1-URGENT')),
    m AS (
      SELECT * FROM discovered WHERE pr <> '5-LOW' AND regexp_matches(released, '^[0-9-]{10}$')),
    detailed AS (SELECT * FROM m WHERE NOT (st = 'O' AND pr = '2-HIGH')),
    remarks AS (
      SELECT o_orderkey, role, text, turn
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth
            FROM conversations) JOIN trailers ON video = 'v' || conv_id
      WHERE nth <= 5 AND role <> 'system'),
    roles AS (
      SELECT o_orderkey, o_custkey + 1 AS cast_id, 'Acting' AS role,
             'Customer ' || o_custkey AS name, pr AS character FROM m
      UNION ALL
      SELECT o_orderkey, CASE st WHEN 'F' THEN o_custkey + 1 ELSE o_custkey + 2000001 END,
             'Director', 'Boss ' || o_custkey, NULL FROM m WHERE st <> 'O')
"""


def _count_sql(counts: dict[str, str]) -> str:
    parts = [f"SELECT '{name}' AS table_name, ({sql})::BIGINT AS n" for name, sql in counts.items()]
    return _BASE + "\nUNION ALL ".join(parts)


LANDING_COUNTS = {
    "tmdb/movies_released": "SELECT count(*) FROM discovered",
    "trakt/movie_ids_and_trailer": "SELECT count(*) FROM found",
    "omdb/movie_ratings": "SELECT count(*) FROM rated",
    "tmdb/movies_providers": "SELECT count(*) FROM found WHERE st <> 'P'",
    "youtube/trailer_video_stats": "SELECT count(*) FROM trailers",
    "rejects/movie_ids": "SELECT (SELECT count(*) FROM discovered) - (SELECT count(*) FROM found)",
}
SERVING_COUNTS = {
    "movies": "SELECT count(*) FROM m",
    "cast": "SELECT count(DISTINCT cast_id) FROM roles",
    "movies_cast": "SELECT count(*) FROM roles",
    "reviews": "SELECT count(*) FROM m WHERE st <> 'P' AND pr <> '2-HIGH'",
    "genres": "SELECT (SELECT count(DISTINCT st) FROM detailed) "
    "+ (SELECT count(DISTINCT pr) FROM detailed)",
    "movies_genres": "SELECT 2 * count(*) FROM detailed",
    "languages": "SELECT 1 + count(DISTINCT st) FROM m WHERE st <> 'P'",
    "movies_languages": "SELECT count(*) + count(*) FILTER (st <> 'P') FROM m",
    "keywords": "SELECT count(DISTINCT pr) FROM m",
    "movies_keywords": "SELECT count(*) FROM m",
    "providers": "SELECT count(DISTINCT pr) FROM found WHERE st <> 'P'",
    "movies_providers": "SELECT 2 * count(*) FROM found WHERE st <> 'P'",
    "imdb_data": "SELECT count(*) FROM rated",
    "external_ratings": "SELECT count(*) + count(*) FILTER (st = 'O') FROM rated",
    "youtube_statistics": "SELECT count(*) FROM trailers",
    "youtube_comments": "SELECT count(*) FROM remarks",
}
TRUSTED_COUNTS = SERVING_COUNTS | {"movie_ids_and_trailer": "SELECT count(*) FROM found"}
VECTOR_COUNTS = {"movie_vectors": "SELECT count(*) FROM m"}


@query("landing_tables", _count_sql(LANDING_COUNTS))
def landing_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts(zones(spark, folder).landing(), list(LANDING_COUNTS))


@query("trusted_tables", _count_sql(TRUSTED_COUNTS))
def trusted_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts(zones(spark, folder).trusted(), list(TRUSTED_COUNTS))


@query("serving_tables", _count_sql(SERVING_COUNTS | VECTOR_COUNTS))
def serving_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts(
        zones(spark, folder).serving(), [*SERVING_COUNTS, *VECTOR_COUNTS]
    )


@query(
    "landing_movies",
    _BASE
    + """
    SELECT (o.o_orderkey + 1)::BIGINT AS tmdb_id, CASE WHEN pr = '5-LOW' THEN '' ELSE 'Order ' || o.o_orderkey END AS title,
           CASE WHEN (st = 'O' AND pr = '2-HIGH') OR pr <> '3-MEDIUM' THEN pr END AS overview, released AS release_date,
           CASE WHEN NOT (st = 'O' AND pr = '2-HIGH') THEN trunc(o_totalprice) END AS budget,
           CASE WHEN st = 'O' THEN 2 ELSE 3 END AS credits, 2 AS reviews, 2 AS languages, 2 AS keywords,
           CASE WHEN st = 'O' AND pr = '2-HIGH' THEN 0 ELSE 2 END AS genres
    FROM discovered o
    """,
)
def landing_movies(spark: SparkSession, folder: str) -> DataFrame:
    """What landed of every movie; of its lists, the lengths."""
    rows = zones(spark, folder).landing().read("tmdb/movies_released")
    lists = [F.json_array_length(c).alias(c) for c in ("credits", "reviews", "languages", "keywords", "genres")]
    return rows.select(
        F.col("tmdb_id").cast("bigint").alias("tmdb_id"), "title", "overview", "release_date",
        F.col("budget").cast("double").alias("budget"), *lists,
    )


@query(
    "landing_providers",
    _BASE
    + """
    SELECT (o_orderkey + 1)::BIGINT AS tmdb_id, kind AS provider_type, pr[1]::INTEGER AS provider_id,
           'Shop ' || pr AS provider_name, '/l.png' AS logo_path, ascii(st)::INTEGER AS display_priority
    FROM found, (VALUES ('flatrate'), ('rent')) AS kinds(kind) WHERE st <> 'P'
    """,
)
def landing_providers(spark: SparkSession, folder: str) -> DataFrame:
    rows = zones(spark, folder).landing().read("tmdb/movies_providers")
    offers = rows.select(
        F.col("tmdb_id").cast("bigint").alias("tmdb_id"), F.inline(F.from_json("providers", schemas.PROVIDERS))
    )
    return offers.select("tmdb_id", "provider_type", "provider_id", "provider_name", "logo_path", "display_priority")


@query(
    "landing_video_stats",
    _BASE
    + """
    SELECT (o_orderkey + 1)::BIGINT AS tmdb_id, 'https://www.youtube.com/watch?v=' || video AS trailer_url,
           CASE WHEN coalesce(event_type, 'error') = 'error' THEN '0'
                ELSE (round(value * 100)::BIGINT * 1000000)::VARCHAR END AS views,
           CASE WHEN coalesce(event_type, 'error') = 'error' THEN '0' ELSE 'n/a' END AS comment_count,
           least(5, coalesce(n, 0))::INTEGER AS comments
    FROM trailers LEFT JOIN events ON video = 'v' || event_id
    LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) ON video = 'v' || conv_id
    """,
)
def landing_video_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = zones(spark, folder).landing().read("youtube/trailer_video_stats")
    counts = F.from_json("statistics", schemas.STATISTICS)
    return rows.select(
        F.col("tmdb_id").cast("bigint").alias("tmdb_id"), "trailer_url", counts["viewCount"].alias("views"),
        counts["commentCount"].alias("comment_count"), F.json_array_length("comments").alias("comments"),
    )


class _Lacking(Dumps):
    """Dumps without one of them."""

    def path(self, kind: str) -> str:
        return super().path(f"absent/{kind}" if kind == "id_search" else kind)


@query(
    "landing_without_a_dump",
    _BASE
    + """
    SELECT * FROM (VALUES ('staged/answers', -1, 'failed'), ('rejects/responses', -1, 'failed'),
      ('trakt/movie_ids_and_trailer', -1, 'skipped'), ('rejects/movie_ids', -1, 'skipped'),
      ('omdb/movie_ratings', -1, 'skipped'), ('tmdb/movies_providers', -1, 'skipped'),
      ('youtube/trailer_video_stats', -1, 'skipped'), ('staged/movies', 0, 'done')) AS t(step, rows, state)
    UNION ALL SELECT 'tmdb/movies_released', count(*), 'done' FROM discovered
    """,
)
def landing_without_a_dump(spark: SparkSession, folder: str) -> DataFrame:
    """The flow's report when one dump is absent: what needs it fails or is skipped, the rest is done."""
    dumps = _Lacking(spark, zones(spark, folder).dumps().root)
    store = TableStore(spark, work_folder(spark, "lacking"))
    report = build_landing(dumps, store, AS_OF, days=WINDOW, discover_region="ES")
    told = [
        (r.table, r.rows if r.ok else -1, "done" if r.ok else "skipped" if r.error.startswith("Skipped") else "failed")
        for r in report.results
    ]
    return spark.createDataFrame(told, "step string, rows long, state string")


@query(
    "trusted_movies",
    _BASE
    + """
    SELECT (m.o_orderkey + 1)::INTEGER AS tmdb_id, 'Order ' || m.o_orderkey AS title,
           CASE WHEN d.o_orderkey IS NULL OR m.pr <> '3-MEDIUM' THEN m.pr END AS overview,
           m.released AS release_date,
           CASE WHEN d.o_orderkey IS NOT NULL THEN trunc(m.o_totalprice) END AS budget,
           CASE WHEN d.o_orderkey IS NULL THEN '' ELSE 'US&' || m.st END AS origin_country
    FROM m LEFT JOIN detailed d USING (o_orderkey)
    """,
)
def trusted_movies(spark: SparkSession, folder: str) -> DataFrame:
    return zones(spark, folder).trusted().read("movies").select(
        "tmdb_id", "title", "overview", "release_date", "budget", "origin_country"
    )


@query(
    "trusted_people",
    _BASE + "SELECT cast_id::INTEGER AS cast_id, min(name) AS name FROM roles GROUP BY cast_id",
)
def trusted_people(spark: SparkSession, folder: str) -> DataFrame:
    return zones(spark, folder).trusted().read("cast")


@query(
    "trusted_roles",
    _BASE
    + """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, cast_id::INTEGER AS cast_id, role, character,
           (o_orderkey + 1) || '_' || cast_id AS movie_cast_id
    FROM roles
    """,
)
def trusted_roles(spark: SparkSession, folder: str) -> DataFrame:
    return zones(spark, folder).trusted().read("movies_cast")


@query(
    "trusted_reviews",
    _BASE
    + """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, 'a' || o_custkey AS author, pr AS content,
           released || CASE pr WHEN '1-URGENT' THEN ' 08:00:00' ELSE ' 10:00:00' END AS created_at,
           CASE st WHEN 'F' THEN 'https://reviews.example/1' END AS url
    FROM m WHERE st <> 'P' AND pr <> '2-HIGH'
    """,
)
def trusted_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return export_rows(
        zones(spark, folder).trusted().read("reviews"), timestamp_format="yyyy-MM-dd HH:mm:ss"
    )


def _trusted(name: str, source: str, columns: list[str], oracle: str) -> None:
    """Register ``name``: these columns of the trusted table ``source``."""

    @query(name, _BASE + oracle)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return zones(spark, folder).trusted().read(source).select(*columns)


_trusted(
    "trusted_genres",
    "genres",
    ["genre_id", "name"],
    """
    SELECT ascii(st)::INTEGER AS genre_id, st AS name FROM detailed
    UNION SELECT pr[1]::INTEGER + 10, pr FROM detailed
    """,
)
_trusted(
    "trusted_movies_genres",
    "movies_genres",
    ["tmdb_id", "genre_id", "movie_genre_id"],
    """
    SELECT tmdb_id, genre_id, tmdb_id || '_' || genre_id AS movie_genre_id
    FROM (SELECT (o_orderkey + 1)::INTEGER AS tmdb_id,
                 unnest([ascii(st)::INTEGER, pr[1]::INTEGER + 10]) AS genre_id FROM detailed)
    """,
)
_trusted(
    "trusted_languages",
    "languages",
    ["iso_639_1", "iso_3166_1", "name"],
    """
    SELECT DISTINCT 'en' AS iso_639_1, 'US' AS iso_3166_1, 'English' AS name FROM m
    UNION SELECT lower(st), 'XX', 'Lang ' || st FROM m WHERE st <> 'P'
    """,
)
_trusted(
    "trusted_movies_languages",
    "movies_languages",
    ["tmdb_id", "iso_639_1", "movie_language_id"],
    """
    SELECT tmdb_id, iso_639_1, tmdb_id || '_' || iso_639_1 AS movie_language_id
    FROM (SELECT (o_orderkey + 1)::INTEGER AS tmdb_id,
                 unnest(CASE st WHEN 'P' THEN ['en'] ELSE ['en', lower(st)] END) AS iso_639_1 FROM m)
    """,
)
_trusted(
    "trusted_keywords",
    "keywords",
    ["keyword_id", "name"],
    "SELECT DISTINCT pr[1]::INTEGER AS keyword_id, pr AS name FROM m",
)
_trusted(
    "trusted_movies_keywords",
    "movies_keywords",
    ["tmdb_id", "keyword_id", "movie_keyword_id"],
    """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, pr[1]::INTEGER AS keyword_id,
           (o_orderkey + 1) || '_' || pr[1] AS movie_keyword_id
    FROM m
    """,
)
_trusted(
    "trusted_providers",
    "providers",
    ["provider_id", "provider_name", "logo_path", "display_priority"],
    """
    SELECT pr[1]::INTEGER AS provider_id, 'Shop ' || pr AS provider_name, '/l.png' AS logo_path,
           min(ascii(st))::INTEGER AS display_priority
    FROM found WHERE st <> 'P' GROUP BY pr
    """,
)
_trusted(
    "trusted_movies_providers",
    "movies_providers",
    ["tmdb_id", "provider_id", "provider_type", "movie_provider_id"],
    """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, pr[1]::INTEGER AS provider_id, kind AS provider_type,
           (o_orderkey + 1) || '_' || pr[1] || '_' || kind AS movie_provider_id
    FROM found, (VALUES ('flatrate'), ('rent')) AS kinds(kind) WHERE st <> 'P'
    """,
)
_trusted(
    "trusted_ids",
    "movie_ids_and_trailer",
    ["tmdb_id", "trakt_id", "slug", "imdb_id", "title", "trailer"],
    """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, (o_orderkey + 1000001)::INTEGER AS trakt_id,
           'order-' || o_orderkey AS slug,
           CASE WHEN pr <> '3-MEDIUM' THEN 'tt' || o_orderkey END AS imdb_id,
           'Order ' || o_orderkey AS title,
           CASE st WHEN 'F' THEN 'https://youtube.com/watch?v=v' || o_orderkey || '&t=1'
                   WHEN 'P' THEN 'https://youtu.be/v' || o_orderkey END AS trailer
    FROM found
    """,
)
_trusted(
    "trusted_external_ratings",
    "external_ratings",
    ["imdb_id", "source", "value", "rating_id"],
    """
    SELECT 'tt' || o_orderkey AS imdb_id, 'IMDb' AS source, '8.7/10' AS value,
           'tt' || o_orderkey || '_IMDb' AS rating_id
    FROM rated
    UNION ALL SELECT 'tt' || o_orderkey, 'RT', '90%', 'tt' || o_orderkey || '_RT' FROM rated WHERE st = 'O'
    """,
)


@query(
    "serving_ratings",
    _BASE
    + """
    SELECT 'tt' || o_orderkey AS imdb_id, (o_orderkey + 1)::INTEGER AS tmdb_id, '8.70' AS imdb_rating,
           trunc(o_totalprice)::BIGINT AS imdb_votes,
           CASE st WHEN 'O' THEN 73 END::DOUBLE AS metascore, pr AS awards,
           CASE st WHEN 'F' THEN 'https://youtube.com/watch?v=v' || o_orderkey || '&t=1' END AS trailer
    FROM rated
    """,
)
def serving_ratings(spark: SparkSession, folder: str) -> DataFrame:
    rows = zones(spark, folder).serving().read("imdb_data")
    return rows.withColumn("metascore", F.col("metascore").cast("double")).drop("poster")


@query(
    "serving_external_ratings",
    _BASE
    + """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, 'tt' || o_orderkey AS imdb_id, source, value
    FROM rated, (VALUES ('IMDb', '8.7/10'), ('RT', '90%')) AS given(source, value)
    WHERE source = 'IMDb' OR st = 'O'
    """,
)
def serving_external_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return zones(spark, folder).serving().read("external_ratings")


@query(
    "serving_video_statistics",
    _BASE
    + """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id,
           CASE WHEN event_type <> 'error' THEN round(value * 100)::BIGINT * 1000000 ELSE 0 END AS views,
           CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END AS likes,
           CASE WHEN event_type <> 'error' THEN NULL ELSE 0 END::DOUBLE AS comments
    FROM (SELECT t.*, coalesce(event_type, 'error') AS event_type, value, user_id
          FROM trailers t LEFT JOIN events ON video = 'v' || event_id)
    """,
)
def serving_video_statistics(spark: SparkSession, folder: str) -> DataFrame:
    rows = zones(spark, folder).serving().read("youtube_statistics")
    return rows.withColumn("comments", F.col("comments").cast("double"))


@query(
    "serving_comments",
    _BASE
    + """
    SELECT (o_orderkey + 1)::INTEGER AS tmdb_id, role AS author, text,
           turn::INTEGER AS likes,
           strftime(TIMESTAMP '2024-01-01' + to_minutes(turn::INTEGER), '%Y-%m-%d %H:%M:%S')
             AS published_at
    FROM remarks
    """,
)
def serving_comments(spark: SparkSession, folder: str) -> DataFrame:
    return zones(spark, folder).serving().read("youtube_comments")
