"""Declared shapes of the movie tables. All fields are nullable.

Fixed values: column names, nested field names and table keys are the data
contract and have to stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- nested columns held as JSON text in landing --------------------------------

CREDITS = "array<struct<id:int,role:string,character:string,name:string>>"
REVIEWS = "array<struct<author:string,content:string,created_at:string,url:string>>"
GENRES = "array<struct<id:int,name:string>>"
LANGUAGES = "array<struct<iso_639_1:string,iso_3166_1:string,name:string>>"
KEYWORDS = "array<struct<id:int,name:string>>"
PROVIDERS = (
    "array<struct<provider_id:int,provider_name:string,logo_path:string,"
    "display_priority:int,provider_type:string>>"
)
RATINGS = "array<struct<Source:string,Value:string>>"
STATISTICS = "struct<viewCount:string,likeCount:string,commentCount:string>"
COMMENTS = "array<struct<author:string,text:string,likes:int,published_at:string>>"
COUNTRIES = "array<string>"

# --- API responses, one JSON document per line ----------------------------------

DISCOVER_PAGE = (
    "page int, total_pages int, results array<struct<id:long,title:string,overview:string,"
    "genre_ids:array<int>,release_date:string,poster_path:string,popularity:double,region:string>>"
)
CREDITS_RESPONSE = (
    "id long, "
    'cast array<struct<id:int,name:string,character:string,order:int>>, '
    "crew array<struct<id:int,name:string,job:string,department:string>>"
)
REVIEWS_RESPONSE = f"id long, results {REVIEWS}"
TRANSLATIONS_RESPONSE = (
    "id long, translations array<struct<iso_639_1:string,iso_3166_1:string,name:string,"
    "data:struct<overview:string,tagline:string>>>"
)
KEYWORDS_RESPONSE = f"id long, keywords {KEYWORDS}"
DETAILS_RESPONSE = (
    "id long, title string, overview string, original_language string, original_title string, "
    f"poster_path string, release_date string, genres {GENRES}, budget long, revenue long, "
    "runtime long, tagline string, origin_country array<string>"
)
# One region holds a text ``link`` beside lists, so the inner values stay JSON text.
PROVIDERS_RESPONSE = "id long, results map<string,map<string,string>>"
ID_SEARCH_RESPONSE = (
    "tmdb_id long, results array<struct<type:string,score:double,"
    "movie:struct<title:string,ids:struct<trakt:long,slug:string,tmdb:long,imdb:string>>>>"
)
ID_DETAILS_RESPONSE = (
    "title string, trailer string, ids struct<trakt:long,slug:string,tmdb:long,imdb:string>"
)
RATINGS_RESPONSE = (
    f"Title string, Poster string, Awards string, Ratings {RATINGS}, Metascore string, "
    "imdbRating string, imdbVotes string, imdbID string"
)
VIDEO_SEARCH_RESPONSE = "title string, items array<struct<id:struct<videoId:string>>>"
VIDEO_STATS_RESPONSE = f"id string, items array<struct<statistics:{STATISTICS}>>"
VIDEO_COMMENTS_RESPONSE = (
    "video_id string, page int, items array<struct<snippet:struct<topLevelComment:"
    "struct<snippet:struct<authorDisplayName:string,textDisplay:string,likeCount:int,"
    "publishedAt:string>>>>>"
)

# --- stream ---------------------------------------------------------------------

BLOG_COMMENT = (
    "tmdb_id int, comment_id string, film_title string, comment_text string, created_at timestamp"
)

# --- fields kept from a discovered and enriched movie ---------------------------

MOVIE_FIELDS = {
    "tmdb_id": "bigint",
    "title": "string",
    "overview": "string",
    "original_language": "string",
    "original_title": "string",
    "poster_path": "string",
    "release_date": "string",
    "credits": CREDITS,
    "reviews": REVIEWS,
    "genres": GENRES,
    "languages": (
        "array<struct<iso_639_1:string,iso_3166_1:string,name:string,"
        "overview:string,tagline:string>>"
    ),
    "keywords": KEYWORDS,
    "budget": "bigint",
    "origin_country": COUNTRIES,
    "runtime": "bigint",
    "revenue": "bigint",
    "tagline": "string",
}

# --- table keys -----------------------------------------------------------------

LANDING_KEYS = {
    "tmdb/movies_released": ["tmdb_id"],
    "trakt/movie_ids_and_trailer": ["trakt_id"],
    "omdb/movie_ratings": ["imdb_id"],
    "tmdb/movies_providers": ["tmdb_id"],
    "youtube/trailer_video_stats": ["tmdb_id"],
    "blog_comments": ["comment_id"],
}

# Bridges and children are matched on their real columns; the joined text keys
# (movie_cast_id and the like) are still written as output columns.
TRUSTED_KEYS = {
    "movies": ["tmdb_id"],
    "cast": ["cast_id"],
    "movies_cast": ["tmdb_id", "cast_id", "role"],
    "reviews": ["tmdb_id", "author", "created_at"],
    "genres": ["genre_id"],
    "movies_genres": ["tmdb_id", "genre_id"],
    "languages": ["iso_639_1"],
    "movies_languages": ["tmdb_id", "iso_639_1"],
    "keywords": ["keyword_id"],
    "movies_keywords": ["tmdb_id", "keyword_id"],
    "providers": ["provider_id"],
    "movies_providers": ["tmdb_id", "provider_id", "provider_type"],
    "movie_ids_and_trailer": ["tmdb_id"],
    "imdb_data": ["imdb_id"],
    "external_ratings": ["imdb_id", "source"],
    "youtube_statistics": ["tmdb_id"],
    "youtube_comments": ["tmdb_id", "author", "published_at"],
}

SERVING_KEYS = {
    name: keys for name, keys in TRUSTED_KEYS.items() if name != "movie_ids_and_trailer"
} | {"external_ratings": ["tmdb_id", "imdb_id", "source"]}

# Columns the serving tables keep; tables not named here keep all of theirs.
SERVING_COLUMNS = {
    "movies_cast": ["tmdb_id", "cast_id", "character", "role"],
    "movies_genres": ["tmdb_id", "genre_id"],
    "movies_languages": ["tmdb_id", "iso_639_1"],
    "movies_keywords": ["tmdb_id", "keyword_id"],
    "movies_providers": ["tmdb_id", "provider_id", "provider_type"],
    "external_ratings": ["tmdb_id", "imdb_id", "source", "value"],
}


def struct_of(ddl: str) -> T.StructType:
    """The ``StructType`` a DDL column list describes."""
    return T.StructType.fromDDL(ddl)
