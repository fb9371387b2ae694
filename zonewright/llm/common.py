"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.session import work_folder


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the session's shared folder and read back, so that later
    jobs neither repeat its work nor depend on an executor that may be gone."""
    spark = df.sparkSession
    path = f"{work_folder(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8_crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8"))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Hand Python at most ``rows`` rows at a time, as texts and pages may be long. Operators call this before
    they run Python, so the library is sent to the executors here."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


@cache
def _package_zip() -> str:
    """The library as a zip file, for executors that do not have it installed."""
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    return str(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the library to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        context.addPyFile(_package_zip())
        _SHIPPED.add(context.applicationId)
