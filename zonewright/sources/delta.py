"""The same table operations on Delta tables, where the session has the library."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonewright.operators.merge import align, count_and_check
from zonewright.session import Staging
from zonewright.sources.files import Files


class DeltaTableStore:
    """Path-addressed Delta tables of one zone, with ``TableStore``'s operations.

    Row-level MERGE, compaction and concurrent writers are the library's.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Files(spark)

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self._files.exists(f"{self._path(name)}/_delta_log")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format("delta").load(self._path(name))

    def show(self, name: str, rows: int = 20) -> int:
        df = self.read(name)
        df.show(rows)
        return df.count()

    def create(
        self,
        name: str,
        df: DataFrame,
        *,
        keys: Sequence[str] = (),
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
    ) -> None:
        writer = df.write.format("delta").mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self._path(name))

    def upsert(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        *,
        writer: tuple[str, int] | None = None,
        partition_by: Sequence[str] = (),
    ) -> int:
        """MERGE on the keys. The source is staged first, so that it is run once for
        the key check and the merge. ``writer`` is not needed: a repeated merge of
        the same keyed rows changes nothing."""
        staging = Staging(self.spark, "merge-source")
        try:
            return self._merge(name, staging.put(df), keys, partition_by)
        finally:
            staging.clear()

    def _merge(
        self, name: str, staged: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
    ) -> int:
        count = count_and_check(staged, keys)
        if count == 0:
            return 0
        if not self.exists(name):
            self.create(name, staged, partition_by=partition_by)
            return count
        table = f"delta.`{self._path(name)}`"
        view = f"merge_source_{uuid.uuid4().hex}"
        align(staged, self.read(name).schema).createOrReplaceTempView(view)
        matched = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        self.spark.sql(
            f"MERGE INTO {table} AS t USING {view} AS s ON {matched} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
        self.spark.catalog.dropTempView(view)
        return count

    def drop(self, name: str) -> bool:
        return self._files.exists(self._path(name)) and self._files.delete(self._path(name))
