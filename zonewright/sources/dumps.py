"""API responses as JSON datasets, one document per line."""

from __future__ import annotations

from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonewright import schemas
from zonewright.schemas import struct_of
from zonewright.session import Staging

# Dump folder to the shape of its documents.
RESPONSES = {
    "discover": schemas.DISCOVER_PAGE,
    "credits": schemas.CREDITS_RESPONSE,
    "reviews": schemas.REVIEWS_RESPONSE,
    "translations": schemas.TRANSLATIONS_RESPONSE,
    "keywords": schemas.KEYWORDS_RESPONSE,
    "details": schemas.DETAILS_RESPONSE,
    "providers": schemas.PROVIDERS_RESPONSE,
    "id_search": schemas.ID_SEARCH_RESPONSE,
    "id_details": schemas.ID_DETAILS_RESPONSE,
    "ratings": schemas.RATINGS_RESPONSE,
    "video_search": schemas.VIDEO_SEARCH_RESPONSE,
    "video_stats": schemas.VIDEO_STATS_RESPONSE,
    "video_comments": schemas.VIDEO_COMMENTS_RESPONSE,
}


# The field each kind of document is told apart by.
ID_FIELDS = {
    "discover": "page",
    "credits": "id",
    "reviews": "id",
    "translations": "id",
    "keywords": "id",
    "details": "id",
    "providers": "id",
    "id_search": "tmdb_id",
    "id_details": "ids",
    "ratings": "imdbID",
    "video_search": "title",
    "video_stats": "id",
    "video_comments": "video_id",
}

_BROKEN = "__broken"
# Documents of one file of a dump that is laid down: files are packed, and a packed one is read by one task.
FILE_DOCUMENTS = 100_000


class Dumps:
    """The dump folders below ``root``, read with declared schemas, never inferred.

    Lines that are no JSON object come back as rows of nulls, and fields of
    another type as null fields; the loaders set rows without an id aside.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def read(self, kind: str) -> DataFrame:
        return self.spark.read.schema(RESPONSES[kind]).json(self.path(kind))

    def parsed_once(self, staging: Staging) -> ParsedDumps:
        """The same dumps for one run, in which each is read and parsed once."""
        return ParsedDumps(self, staging)

    def write(self, kind: str, documents: DataFrame) -> None:
        """Lay down a dump, for instance one that is derived from other tables."""
        writer = documents.write.mode("errorifexists").option("maxRecordsPerFile", FILE_DOCUMENTS)
        writer.json(self.path(kind), compression="gzip")


class ParsedDumps(Dumps):
    """Dumps of one run. A dump's lines are parsed when it is first asked for, and staged with the text
    of those that could not be read whole; responses and rejects are both taken from there."""

    def __init__(self, source: Dumps, staging: Staging) -> None:
        super().__init__(source.spark, source.root)
        self.path = source.path
        self._staging = staging
        self._parsed: dict[str, DataFrame] = {}
        self._locks = {kind: Lock() for kind in RESPONSES}

    def _lines(self, kind: str) -> DataFrame:
        with self._locks[kind]:
            if kind not in self._parsed:
                schema = T.StructType([*struct_of(RESPONSES[kind]).fields, T.StructField(_BROKEN, T.StringType())])
                reader = self.spark.read.schema(schema).option("columnNameOfCorruptRecord", _BROKEN)
                self._parsed[kind] = self._staging.put(reader.json(self.path(kind)))
            return self._parsed[kind]

    def read(self, kind: str) -> DataFrame:
        return self._lines(kind).drop(_BROKEN)

    def unreadable(self) -> DataFrame:
        """Distinct lines of all dumps that are no JSON, or whose id is of another type, as
        ``(kind, line)``. A line that lacks other fields, or has them of another type, is a response."""
        frames = [
            self._lines(kind)
            .filter(F.col(_BROKEN).isNotNull() & F.col(id_field).isNull())
            .select(F.lit(kind).alias("kind"), F.col(_BROKEN).alias("line"))
            for kind, id_field in ID_FIELDS.items()
        ]
        return reduce(DataFrame.unionByName, frames).distinct()
