"""Session builder and the shared folder for tables a job writes along the way."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from zonewright.sources.files import Files


def build_session(app: str = "zonewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ANSI mode stays on (bad casts are handled with ``try_cast``), the zone is
    UTC, and AQE sizes shuffles, converts joins and splits skewed partitions.
    Partition counts and memory are the cluster's business unless passed in.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, empty folder name below the shared folder the session names.

    Every call gives another name, so a rerun never reads an older run's files. All of
    an application's names are below one folder, which goes when the application ends.
    A cluster must name the shared folder in ``spark.checkpoint.dir``; only a local
    master may go without.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = "/tmp/zonewright"
    own = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
    Files(spark).make_temporary(own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


# Rows of one file. A task reads files up to ``spark.sql.files.maxPartitionBytes`` together, however well they
# are packed, and each counts as 4 MB more than it has: so this bounds the rows that a task sorts.
FILE_ROWS = 65_536
# What Spark takes a byte of a file for when it decides by size which join side goes through the driver.
UNPACKED = "20.0"
# Files of different folders that a task may write at once before its rows are sorted by folder.
OPEN_FILES = 3


def packed(writer: DataFrameWriter) -> DataFrameWriter:
    """``writer`` with the codec and the rows a file of what is kept on the shared folder."""
    return writer.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS)


def sizes_unpacked(spark: SparkSession) -> None:
    """Have the session plan joins by what files hold, not by what they take: packed columns of a few
    bytes a row are broadcast else, whatever becomes of them in memory."""
    if float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) < float(UNPACKED):
        spark.conf.set("spark.sql.sources.fileCompressionFactor", UNPACKED)


def writes_unsorted(spark: SparkSession) -> None:
    """Have a task that deals its rows into one bucket, and those without a key, write both as the rows
    come. Else every task first sorts its whole rows by the folder they go to, which is mostly one."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(name)) == 0:
        spark.conf.set(name, OPEN_FILES)


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """While this lasts, the shuffle files of a query go when it ends, not when the driver happens to
    collect its garbage: the disk then holds those of the queries that run, not of a whole flow."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Staging:
    """Frames several tables are made from, written once to the shared folder and read
    back. Each table then scans only the columns it needs, and a lost executor costs
    no more than a read. ``clear`` deletes the files when all tables are written."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = work_folder(spark, label)
        sizes_unpacked(spark)
        self._numbers = itertools.count()

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{next(self._numbers)}"
        packed(df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        Files(self.spark).delete(self.root)
