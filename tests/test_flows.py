"""The three flows over a handful of responses, with the odd cases laid in."""

import json
from datetime import date, datetime

import pytest

from zonewright import schemas
from zonewright.operators.export import export_rows
from zonewright.functions.embedding import FeatureHashing
from zonewright.operators.vectors import query_vector
from zonewright.plans import serving, trusted
from zonewright.plans.landing import build_landing, discovered_movies, movie_ids
from zonewright.plans.report import FlowFailed, FlowReport
from zonewright.plans.serving import build_serving, movie_items, refresh_vectors, search
from zonewright.plans.trusted import build_trusted
from zonewright.sources.dumps import RESPONSES, Dumps
from zonewright.sources.files import Files
from zonewright.sources.store import TableStore

AS_OF = date(2024, 5, 8)


def movie(i, title, day="2024-05-03", **more):
    base = {"id": i, "title": title, "release_date": day, "region": "ES", "genre_ids": [1]}
    return {"overview": f"about {title}", "popularity": 1.0, "poster_path": "/p", **base, **more}


def found_id(i, trakt, **ids):
    known = {"trakt": trakt, "tmdb": i, "slug": f"s{i}", **ids}
    return known


def comment(author, text, at, likes=1):
    inner = {"authorDisplayName": author, "textDisplay": text, "likeCount": likes, "publishedAt": at}
    return {"snippet": {"topLevelComment": {"snippet": inner}}}


DOCUMENTS = {
    "discover": [
        {"page": 1, "total_pages": 2, "results": [movie(1, "One"), movie(2, "Two", "2024-05-08")]},
        {
            "page": 2,
            "total_pages": 2,
            "results": [
                movie(1, "One older", popularity=0.5),
                movie(3, ""),
                movie(4, "Early", "2024-04-30"),
                movie(5, "Elsewhere", region="US"),
                movie(6, "Six"),
                movie(None, "No id"),
            ],
        },
    ],
    "credits": [
        {
            "id": 1,
            "cast": [
                {"id": 10, "name": "Ann", "character": "X", "order": 0},
                {"id": 11, "name": "Bob", "character": "Y", "order": 4},
                {"id": 12, "name": "Far", "character": "Z", "order": 5},
            ],
            "crew": [
                {"id": 13, "name": "Cy", "job": "Writer", "department": "Writing"},
                {"id": 10, "name": "Ann", "job": "Director", "department": "Directing"},
                {"id": 14, "name": "Di", "job": "Director", "department": "Directing"},
            ],
        },
        {"id": 2, "cast": [{"id": 11, "name": "Bobby", "character": "Q", "order": 1}], "crew": []},
    ],
    "reviews": [
        {
            "id": 1,
            "results": [
                {"author": "r1", "content": "fine", "created_at": "2024-01-01T00:00:00.000Z", "url": "https://r.io"},
                {"author": "r2", "content": "ok", "created_at": "2024-01-01T00:00:00+02:00", "url": "www.x"},
                {"author": "", "content": "no author", "created_at": "2024-01-01T00:00:00Z", "url": None},
                {"author": "r3", "content": "bad date", "created_at": "soon", "url": None},
            ],
        }
    ],
    "translations": [
        {
            "id": 1,
            "translations": [
                {"iso_639_1": "en", "iso_3166_1": "US", "name": "English", "data": {"overview": "o", "tagline": "t"}},
                {"iso_639_1": "es", "iso_3166_1": "ES", "name": "", "data": {"overview": "", "tagline": ""}},
            ],
        }
    ],
    "keywords": [{"id": 1, "keywords": [{"id": 7, "name": "k7"}, {"id": None, "name": "x"}]}],
    "details": [
        {
            "id": 1,
            "title": "One!",
            "overview": None,
            "release_date": "2024-05-03",
            "genres": [{"id": 1, "name": "Drama"}, {"id": 2, "name": None}],
            "budget": 3_000_000_000,
            "revenue": 1,
            "runtime": 90,
            "origin_country": ["US", "FR"],
            "unknown": "x",
        }
    ],
    "providers": [
        {
            "id": 1,
            "results": {
                "ES": {
                    "link": "https://l",
                    "flatrate": [{"provider_id": 1, "provider_name": "P", "logo_path": "/1", "display_priority": 2}],
                    "rent": [
                        {"provider_id": 1, "provider_name": "P", "logo_path": "/1", "display_priority": 1},
                        {"provider_id": 2, "provider_name": "Q", "logo_path": "/2", "display_priority": 3},
                    ],
                }
            },
        },
        {"id": 2, "results": {"US": {"buy": [{"provider_id": 3, "provider_name": "R"}]}}},
    ],
    "id_search": [
        {"tmdb_id": 1, "results": [{"type": "show"}, {"type": "movie", "movie": {"ids": {"trakt": 101}}}]},
        {"tmdb_id": 2, "results": [{"type": "movie", "movie": {"ids": {"trakt": 102}}}]},
        {"tmdb_id": 3, "results": [{"type": "show"}]},
        {"tmdb_id": 6, "results": [{"type": "movie", "movie": {"ids": {"trakt": 106}}}]},
    ],
    "id_details": [
        {"title": "One", "trailer": "https://y.com/watch?v=v1&t=3", "ids": found_id(1, 101, imdb="tt1")},
        {"title": "Two", "ids": found_id(2, 102, imdb="tt2")},
    ],
    "ratings": [
        {
            "Title": "One",
            "Poster": "p",
            "Awards": "a",
            "Ratings": [{"Source": "IMDb", "Value": "8/10"}, {"Source": "RT", "Value": ""}],
            "Metascore": "N/A",
            "imdbRating": "8.7",
            "imdbVotes": "1,868,413",
            "imdbID": "tt1",
        },
        {"imdbID": "tt2"},
        {"Title": "unknown", "imdbID": "tt9"},
    ],
    "video_search": [{"title": "Two", "items": [{"id": {"videoId": "v2"}}]}, {"title": "One", "items": []}],
    "video_stats": [
        {"id": "v1", "items": [{"statistics": {"viewCount": "3000000000", "likeCount": "5", "commentCount": "x"}}]},
        {"id": "v2", "items": []},
    ],
    "video_comments": [
        {"video_id": "v1", "page": 2, "items": [comment(f"u{i}", "t", "2024-01-01T00:00:00Z") for i in range(4)]},
        {
            "video_id": "v1",
            "page": 1,
            "items": [
                comment("first", "t", "2024-01-02T00:00:00Z"),
                comment("nodate", "t", "?"),
                comment("first", "t", "2024-01-03T00:00:00+01:00"),
            ],
        },
    ],
}


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flows")
    for kind in RESPONSES:
        (root / "dumps" / kind).mkdir(parents=True)
        lines = [json.dumps(d) for d in DOCUMENTS[kind]]
        if kind == "credits":
            lines += ["{broken", '{"id": "text"}', ""]
        (root / "dumps" / kind / "part.json").write_text("\n".join(lines))
    dumps = Dumps(spark, str(root / "dumps"))
    stores = {n: TableStore(spark, str(root / n)) for n in ("landing", "trusted", "serving")}
    reports = {}
    for _ in range(2):  # a second run over the same responses changes nothing
        reports["landing"] = build_landing(dumps, stores["landing"], AS_OF, discover_region="ES")
        reports["trusted"] = build_trusted(stores["landing"], stores["trusted"])
        reports["serving"] = build_serving(stores["trusted"], stores["serving"], FeatureHashing(16))
        for report in reports.values():
            report.finish()
    return {"dumps": dumps, "reports": reports, **stores}


@pytest.fixture
def read(zones, rows):
    def collect(zone, table, *columns):
        df = zones[zone].read(table)
        return rows(df.select(*columns) if columns else df)

    return collect


def test_discovery_window_region_and_pages(zones, rows):
    got = discovered_movies(zones["dumps"], AS_OF, region="ES").select("tmdb_id", "title")
    assert rows(got) == [(1, "One"), (2, "Two"), (3, ""), (6, "Six")]
    assert discovered_movies(zones["dumps"], AS_OF, days=60).count() == 6


def test_landing_movies(read):
    assert read("landing", "tmdb/movies_released", "tmdb_id", "title", "overview", "budget") == [
        (1, "One!", None, 3_000_000_000),  # details win, also with a null
        (2, "Two", "about Two", None),
        (3, "", "about ", None),
        (6, "Six", "about Six", None),
    ]
    credits = dict(read("landing", "tmdb/movies_released", "tmdb_id", "credits"))
    names = [(c["name"], c["role"]) for c in json.loads(credits[1])]
    assert names == [("Ann", "Acting"), ("Bob", "Acting"), ("Ann", "Director")]
    assert json.loads(credits[2]) == [{"id": 11, "role": "Acting", "character": "Q", "name": "Bobby"}]
    assert credits[3] == "[]"
    languages = dict(read("landing", "tmdb/movies_released", "tmdb_id", "languages"))
    assert json.loads(languages[1])[0]["overview"] == "o"


def test_landing_ids_and_rejects(zones, read, rows):
    assert read("landing", "trakt/movie_ids_and_trailer") == [
        ("One", "https://y.com/watch?v=v1&t=3", 1, 101, "s1", "tt1"),
        ("Two", None, 2, 102, "s2", "tt2"),
    ]
    assert read("landing", "rejects/movie_ids") == [
        (3, "no movie among the search results"),
        (6, "no details for the id"),
    ]
    assert set(read("landing", "rejects/responses")) == {
        ("credits", "{broken"),
        ("credits", '{"id": "text"}'),
    }
    movies = discovered_movies(zones["dumps"], AS_OF, region="ES")
    found, missing = movie_ids(movies, zones["dumps"])
    assert found.count() + missing.count() == movies.count()


def test_nothing_staged_is_left_behind(zones, spark):
    left = Files(spark).names(spark.conf.get("spark.checkpoint.dir"))
    assert not [n for n in left if n.startswith("landing-")]


def test_landing_lookups(read):
    assert read("landing", "omdb/movie_ratings", "imdb_id", "imdb_votes", "metascore") == [
        ("tt1", "1,868,413", "N/A"),
        ("tt2", None, None),
    ]
    (only,) = read("landing", "tmdb/movies_providers")
    kinds = [(p["provider_id"], p["provider_type"]) for p in json.loads(only[1])]
    assert only[0] == 1 and kinds == [(1, "flatrate"), (1, "rent"), (2, "rent")]
    one, two = read("landing", "youtube/trailer_video_stats")
    assert one[0] == 1 and one[3] == "https://www.youtube.com/watch?v=v1"
    assert [c["author"] for c in json.loads(one[2])] == ["first", "nodate", "first", "u0", "u1"]
    zero = {"viewCount": "0", "likeCount": "0", "commentCount": "0"}
    assert (two[0], json.loads(two[1]), two[2]) == (2, zero, "[]")


def test_trusted_movies(read, zones):
    columns = ["tmdb_id", "title", "release_date", "budget", "origin_country"]
    assert read("trusted", "movies", *columns) == [
        (1, "One!", "2024-05-03", 3e9, "US&FR"),
        (2, "Two", "2024-05-08", None, ""),
        (6, "Six", "2024-05-03", None, ""),
    ]
    assert not set(trusted.NESTED) & set(zones["trusted"].read("movies").columns)
    assert zones["reports"]["trusted"].metrics == {"movies_read": 4, "movies_kept": 3}


def test_trusted_people(read):
    assert read("trusted", "cast") == [(10, "Ann"), (11, "Bob")]
    assert read("trusted", "movies_cast") == [
        (1, 10, "Acting", "X", "1_10"),
        (1, 10, "Director", None, "1_10"),
        (1, 11, "Acting", "Y", "1_11"),
        (2, 11, "Acting", "Q", "2_11"),
    ]


def test_trusted_children(read):
    assert read("trusted", "reviews") == [
        (1, "r1", "fine", datetime(2024, 1, 1), "https://r.io"),
        (1, "r2", "ok", datetime(2023, 12, 31, 22), None),
    ]
    assert read("trusted", "youtube_comments", "author", "published_at") == [
        ("first", datetime(2024, 1, 2)),
        ("first", datetime(2024, 1, 2, 23)),
        ("u0", datetime(2024, 1, 1)),
        ("u1", datetime(2024, 1, 1)),
    ]
    assert read("trusted", "youtube_statistics") == [(1, 3_000_000_000, 5, None), (2, 0, 0, 0)]


def test_trusted_dimensions(read):
    assert read("trusted", "genres") == [(1, "Drama")]
    assert read("trusted", "movies_genres") == [(1, 1, "1_1")]
    assert read("trusted", "languages") == [("en", "US", "English")]
    assert read("trusted", "movies_languages") == [(1, "en", "1_en")]
    assert read("trusted", "keywords") == [(7, "k7")]
    assert read("trusted", "movies_keywords") == [(1, 7, "1_7")]
    assert read("trusted", "providers") == [(1, "P", "/1", 1), (2, "Q", "/2", 3)]
    assert [r[3] for r in read("trusted", "movies_providers")] == ["1_1_flatrate", "1_1_rent", "1_2_rent"]


def test_trusted_ratings(read):
    assert read("trusted", "imdb_data") == [
        ("tt1", "8.70", 1868413, None, "a", "p"),
        ("tt2", None, None, None, None, None),
    ]
    assert read("trusted", "external_ratings") == [("tt1", "IMDb", "8/10", "tt1_IMDb")]
    assert read("trusted", "movie_ids_and_trailer", "tmdb_id", "trakt_id") == [(1, 101), (2, 102)]


def test_every_trusted_key_is_unique(zones):
    for table, keys in schemas.TRUSTED_KEYS.items():
        df = zones["trusted"].read(table)
        assert df.count() == df.select(*keys).distinct().count(), table


def test_serving_tables(zones, read):
    assert read("serving", "imdb_data", "imdb_id", "tmdb_id", "trailer") == [
        ("tt1", 1, "https://y.com/watch?v=v1&t=3"),
        ("tt2", 2, None),
    ]
    assert read("serving", "external_ratings") == [(1, "tt1", "IMDb", "8/10")]
    assert zones["serving"].read("movies_cast").columns == ["tmdb_id", "cast_id", "character", "role"]
    assert dict(zones["serving"].read("reviews").dtypes)["created_at"] == "string"
    assert [r.table for r in zones["reports"]["serving"].results if not r.ok] == []
    for table in schemas.SERVING_KEYS:
        assert zones["serving"].exists(table), table


def test_vectors_are_refreshed_only_where_something_changed(zones, spark):
    embed, store = FeatureHashing(16), zones["serving"]
    before = store.read(serving.VECTORS).count()
    items = movie_items(export_rows(zones["trusted"].read("movies")))
    assert before == 3
    assert refresh_vectors(items, store, embed) == 0
    movies = zones["trusted"].read("movies")
    renamed = movies.replace({"Six": "Seven"}, subset=["title"]).withColumn(
        "runtime", movies["tmdb_id"].cast("double")
    )
    changed = movie_items(export_rows(renamed))

    class Fails:
        vector = query_vector(spark, "Seven", embed)

        def __call__(self, texts):
            assert all("Seven" in t for t in texts), texts
            return [self.vector] * len(texts)

    assert refresh_vectors(changed, store, Fails()) == 3  # one new text, two new metadata
    best = search(store, "Seven", embed, 2).collect()
    assert [r["rank"] for r in best] == [1, 2]
    assert best[0]["metadata"]["title"] == "Seven" and best[0]["id"] == "6"


def test_ratings_without_a_movie_are_set_aside(spark, tmp_path, rows):
    source, target = TableStore(spark, str(tmp_path / "t")), TableStore(spark, str(tmp_path / "s"))
    ratings = spark.createDataFrame(
        [("tt1", "A", "1", "x"), ("tt5", "A", "2", "x")], "imdb_id string, source string, value string, rating_id string"
    )
    ids = spark.createDataFrame(
        [(1, "tt1", None, 1), (2, "tt1", None, 2)], "tmdb_id int, imdb_id string, trailer string, trakt_id int"
    )
    source.create("external_ratings", ratings, keys=["imdb_id", "source"])
    source.create("movie_ids_and_trailer", ids, keys=["tmdb_id"])
    for _ in range(2):
        build_serving(source, target).finish()
    assert rows(target.read("external_ratings")) == [(1, "tt1", "A", "1")]
    assert rows(target.read("rejects/external_ratings")) == [("tt5", "A", "2")]


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path):
    source, target = TableStore(spark, str(tmp_path / "t")), TableStore(spark, str(tmp_path / "s"))
    source.create("cast", spark.createDataFrame([(1, "a")], "cast_id int, name string"))
    source.create("imdb_data", spark.createDataFrame([("t",)], "imdb_id string"))  # ids are missing
    report = build_serving(source, target)
    status = {r.table: r.ok for r in report.results}
    assert status["cast"] and not status["imdb_data"]
    assert target.read("cast").count() == 1
    with pytest.raises(FlowFailed, match="imdb_data: TableNotFound"):
        report.finish()


def test_both_ratings_of_a_movie_with_two_ids_are_served(spark, tmp_path, rows):
    source, target = TableStore(spark, str(tmp_path / "t")), TableStore(spark, str(tmp_path / "s"))
    ratings = spark.createDataFrame(
        [("tt1", "A", "1", "x"), ("tt2", "A", "2", "x")], "imdb_id string, source string, value string, rating_id string"
    )
    ids = spark.createDataFrame(
        [(1, "tt1", None, 1), (1, "tt2", None, 2)], "tmdb_id int, imdb_id string, trailer string, trakt_id int"
    )
    source.create("external_ratings", ratings, keys=["imdb_id", "source"])
    source.create("movie_ids_and_trailer", ids, keys=["trakt_id"])
    sent = {}
    build_serving(source, target, sink=lambda t, df, keys: sent.update({t: (keys, df.count())})).finish()
    assert rows(target.read("external_ratings")) == [(1, "tt1", "A", "1"), (1, "tt2", "A", "2")]
    assert sent == {"external_ratings": (["tmdb_id", "imdb_id", "source"], 2)}


def test_a_dump_that_is_absent_stops_only_what_needs_it(spark, tmp_path, zones):
    from shutil import copytree, ignore_patterns

    copytree(zones["dumps"].root, tmp_path / "dumps", ignore=ignore_patterns("id_search"))
    store = TableStore(spark, str(tmp_path / "landing"))
    report = build_landing(Dumps(spark, str(tmp_path / "dumps")), store, AS_OF, discover_region="ES")
    failed = {r.table: r.error for r in report.results if not r.ok}
    assert store.read("tmdb/movies_released").count() > 0
    assert "AnalysisException" in failed["staged/answers"]
    assert failed["trakt/movie_ids_and_trailer"].startswith("Skipped")
    assert failed["omdb/movie_ratings"].startswith("Skipped")
    with pytest.raises(FlowFailed, match="staged/answers"):
        report.finish()


def test_two_ids_of_one_movie_leave_one_row(spark, rows):
    landing = spark.createDataFrame(
        [("T", None, "1", 9, "b", "tt9"), ("T", None, "1", 8, "a", "tt8"), ("X", None, "x", 7, "c", "tt7")],
        "title string, trailer string, tmdb_id string, trakt_id long, slug string, imdb_id string",
    )
    got = trusted.movie_ids(landing)
    assert rows(got.select("tmdb_id", "trakt_id", "imdb_id")) == [(1, 8, "tt8")]


def test_odd_landing_values_never_fail_a_flow(spark, rows):
    odd = ["", "null", "NaN", "{broken", "[1, 2]", '{"id": 1}', '[{"id": "x"}]', None]
    columns = ", ".join(f"{c} string" for c in [*trusted.NESTED, "origin_country"])
    texts = ["title", "overview", "original_language", "original_title", "poster_path", "tagline"]
    numbers = ["budget", "revenue", "runtime"]
    data = [
        (str(i), *["t"] * 6, *["1e400", "x", "7"], "2024-01-01", *[o] * 6)
        for i, o in enumerate(odd)
    ] + [("3000000000", *["t"] * 6, *["1"] * 3, "2024-01-01", *[None] * 6)]
    landing = spark.createDataFrame(
        data,
        "tmdb_id string, "
        + ", ".join(f"{c} string" for c in [*texts, *numbers, "release_date"])
        + f", {columns}",
    )
    clean = trusted.clean_movies(landing)
    assert [r[0] for r in rows(trusted.movies(clean).select("tmdb_id"))] == list(range(len(odd)))
    assert "original_language" in clean.columns
    for name in ("credits", "genres", "languages", "keywords"):
        take, split, _ = trusted.NORMALIZED[name]
        dim, bridge = split(take(clean))
        assert dim.count() == 0 and bridge.count() in (0, 1)
    assert trusted.reviews(clean).count() == 0


def test_every_list_is_parsed_once(zones, spark, tmp_path, monkeypatch):
    taken = []

    def counted(df, parent, column, *rest, **options):
        taken.append(column)
        return explode(df, parent, column, *rest, **options)

    explode = trusted.explode_children
    monkeypatch.setattr(trusted, "explode_children", counted)
    target = TableStore(spark, str(tmp_path / "trusted"))
    trusted.build_trusted(zones["landing"], target).finish()
    assert sorted(taken) == ["comments", "credits", "genres", "keywords", "languages", "providers", "ratings", "reviews"]
    for table in ("cast", "movies_cast", "providers"):
        assert target.read(table).count() == zones["trusted"].read(table).count() > 0


def test_every_dump_is_read_once(zones, spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    read = []

    def counted(self, path, *rest, **options):
        read.append(path.rsplit("/", 1)[1])
        return json_reader(self, path, *rest, **options)

    json_reader = DataFrameReader.json
    monkeypatch.setattr(DataFrameReader, "json", counted)
    monkeypatch.setattr(DataFrameReader, "text", None)
    build_landing(zones["dumps"], TableStore(spark, str(tmp_path / "landing")), AS_OF, discover_region="ES").finish()
    assert sorted(read) == sorted(RESPONSES)


def test_only_wanted_videos_are_ranked(zones, spark, tmp_path):
    from zonewright.plans.landing import trailer_stats

    ids = zones["landing"].read("trakt/movie_ids_and_trailer")
    plan = trailer_stats(ids, zones["dumps"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan
    # The semi-joins stand below the windows that rank statistics and comments.
    assert plan.count("LeftSemi") >= 2 and plan.index("Window") < plan.rindex("LeftSemi")


def test_narrowing_shares_the_shuffle_of_a_skewed_lookup(spark, tmp_path, rows):
    from zonewright.operators.enrich import lookup_join
    from zonewright.plans.landing import narrowed

    def stored(name, data, ddl):
        spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    left = stored("l", [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c")], "n int, k string")
    right = stored("r", [("a", 2), ("a", 1), ("b", 3), (None, 4), ("d", 5)], "k string, v int")
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "-1")
        kept = narrowed(right, left, ["k"], for_skewed_join=True)
        assert rows(kept) == rows(narrowed(right, left, ["k"])) == [("a", 1), ("a", 2), ("b", 3)]
        joined = lookup_join(left, kept, ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # Either side of the narrowing and of the join: the ranking between them has none of its own.
        assert plan.count("Exchange hashpartitioning") == 4
        assert rows(joined) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 3), ("c", 5, None), (None, 4, None)]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_statistics_are_parsed_once(spark, tmp_path, rows):
    data = [("1", '{"viewCount": "1,000", "likeCount": "x"}'), ("2", None), ("3", "no json"), ("4", '{"commentCount": 7}')]
    spark.createDataFrame(data, "tmdb_id string, statistics string").write.parquet(str(tmp_path / "s"))
    found = trusted.video_statistics(spark.read.parquet(str(tmp_path / "s")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert rows(found) == [(1, 1000, None, None), (2, None, None, None), (3, None, None, None), (4, None, None, 7)]


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled()
    setting = spark.conf.get(name)
    steps = {n: lambda: len(spark.range(1000).repartition(3, "id").groupBy("id").count().collect()) for n in "ab"}
    report = FlowReport()
    report.run_all(spark, steps)
    assert [r.rows for r in report.finish().results] == [1000, 1000]
    assert shuffled() <= before and spark.conf.get(name) == setting


def test_report_order():
    report = FlowReport()
    report.run("a", lambda: 3)
    report.run("b", lambda: 1 // 0)
    assert [(r.table, r.rows, r.ok) for r in report.results] == [("a", 3, True), ("b", None, False)]


def test_dumps_that_are_laid_down_are_packed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("zonewright.sources.dumps.FILE_DOCUMENTS", 100)
    dumps = Dumps(spark, str(tmp_path / "dumps"))
    dumps.write("keywords", spark.range(1000).selectExpr("id", "array(struct(1 AS id, 'k' AS name)) AS keywords").coalesce(1))
    names = [n for n in Files(spark).names(dumps.path("keywords")) if n.startswith("part-")]
    assert len(names) == 10 and all(n.endswith(".json.gz") for n in names)
    assert dumps.read("keywords").selectExpr("count(*)", "sum(id)", "min(keywords[0].name)").first()[:] == (1000, 499500, "k")
