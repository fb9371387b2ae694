"""Keyed tables in a zone folder, on plain Parquet.

A table is a folder of Parquet data sets and one small file, ``current``, that names the
data sets of the present version, its schema and its keys. Every write makes new data sets
and replaces that file last, so a reader sees the version before or the one after, and a
read is a plain scan.

The rows of a keyed table are dealt into buckets by a hash of the key, each with data sets
of its own. An upsert merges, when it writes, the buckets that hold a changed key; the data
sets of all others stay as they are, so what it reads and writes follows the changes. Rows
with a null key match nothing: they are only ever added, to a bucket that is never merged.
The data sets of the version before are kept for its readers; older ones are deleted. One
writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from zonewright.operators.dedup import all_present
from zonewright.operators.merge import align, count_and_check, merge_checked
from zonewright.session import packed, sizes_unpacked, writes_unsorted
from zonewright.sources.files import Files

# Bytes a bucket should hold; a table that comes to four times as much for each of its buckets is
# dealt anew. A bucket's files are split by size, whatever it holds.
BUCKET_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 4096
# Data sets of rows with null keys after which these are written anew as one.
LOOSE_SETS = 32
# Folders of a data set, named so that all of a table's are read as one.
_SET = "__set"
_BUCKET = "__bucket"
_LOOSE = "-1"
_WHOLE = "all"


class TableNotFound(LookupError):
    """The zone has no such table."""


@dataclass
class _Version:
    schema: dict
    keys: list[str] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    buckets: int = 1
    data: dict[str, list[str]] = field(default_factory=dict)
    bytes: dict[str, int] = field(default_factory=dict)
    before: list[str] = field(default_factory=list)
    applied: dict[str, int] = field(default_factory=dict)

    def sets(self) -> list[str]:
        return [s for sets in self.data.values() for s in sets]


class TableStore:
    """Tables of one zone below ``root``. Keyed ones have as many buckets as their size asks for, and more
    as they grow, or always ``buckets``."""

    def __init__(self, spark: SparkSession, root: str, *, buckets: int | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._files = Files(spark)
        sizes_unpacked(spark)
        writes_unsorted(spark)

    # --- reading ----------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self._files.exists(self._pointer(name))

    def names(self) -> list[str]:
        """Tables right below the zone folder."""
        return [n for n in self._files.names(self.root) if self.exists(n)]

    def read(self, name: str) -> DataFrame:
        """The table's current rows."""
        return self._rows(name, self._version(name))

    def show(self, name: str, rows: int = 20) -> int:
        """Print the first rows and return the row count."""
        df = self.read(name)
        df.show(rows)
        return df.count()

    # --- writing ----------------------------------------------------------------

    def create(
        self,
        name: str,
        df: DataFrame,
        *,
        keys: Sequence[str] = (),
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
    ) -> None:
        """Write the whole frame: ``overwrite``, ``append``, ``ignore`` or ``error``. A full
        key that repeats, also with one already in the table, raises ``DuplicateKeys`` and
        leaves the table as it was."""
        old = self._version(name) if self.exists(name) else None
        if old and mode == "ignore":
            return
        if old and mode == "error":
            raise FileExistsError(f"{self.root}/{name}")
        if old and mode == "append":
            new = self._next(old)
            rows = align(df, T.StructType.fromJson(old.schema))
        else:
            new = _Version(_nullable(df.schema).jsonValue(), list(keys), list(partition_by), self.buckets or 1)
            new.applied = old.applied if old else {}
            rows = df
        written = self._write(name, rows, new)
        for bucket, sets in written.items():
            new.data[bucket] = [*new.data.get(bucket, []), *sets]
        if new.keys:
            # A key that is there already is in the bucket its copy has come to.
            self._checked(name, written, self._rows(name, new, written), new.keys)
            self._note_sizes(name, new, written)
            if old and mode == "append" and self._outgrown(new):
                self._deal_anew(name, old, new)
        self._publish(name, old, new)

    def upsert(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        *,
        writer: tuple[str, int] | None = None,
        partition_by: Sequence[str] = (),
    ) -> int:
        """Replace the rows the keys match and insert the others; rows written.

        No rows is no change, and does not create the table. The first upsert
        creates it. A key that repeats in ``df`` raises ``DuplicateKeys`` and
        leaves the table as it was; null keys match nothing and are inserted.

        ``df`` is run once: its rows are written below the table's folder, their keys are
        checked there, and the merge reads them from there. ``writer``, a name and a
        growing number, makes a repeated call a no-op.
        """
        old = self._version(name) if self.exists(name) else None
        if old and writer and old.applied.get(writer[0], -1) >= writer[1]:
            return 0
        if old and old.keys != list(keys):
            raise ValueError(f"{name} is keyed by {old.keys}, not {list(keys)}")
        new = (
            self._next(old)
            if old
            else _Version(_nullable(df.schema).jsonValue(), list(keys), list(partition_by), self.buckets or 1)
        )
        rows = align(df, T.StructType.fromJson(old.schema)) if old else df
        written = self._write(name, rows, new)
        if not written:
            return 0
        changes = _Version(new.schema, data=written)
        count = self._checked(name, written, self._rows(name, changes), keys)
        merged = [b for b in written if b in new.data and b != _LOOSE]
        if merged and self._outgrown(new, sum(self._size(name, s) for b, sets in written.items() if b != _LOOSE for s in sets)):
            # The merge writes every bucket, and so deals their rows into as many as they ask for.
            merged = [b for b in new.data | written if b != _LOOSE]
        if merged:
            both = merge_checked(self._rows(name, new, merged), self._rows(name, changes, merged), keys)
            together = self._write(name, both, new)
            done = [s for b in merged for s in written.get(b, [])]
            self._delete(name, done, [s for b in written if b not in merged for s in written[b]])
            written = {b: s for b, s in written.items() if b not in merged} | together
            new.data = {b: s for b, s in new.data.items() if b not in merged}
            new.bytes = {b: n for b, n in new.bytes.items() if b not in merged}
        if _LOOSE in written:
            written[_LOOSE] = self._gathered(name, new, [*new.data.get(_LOOSE, []), *written[_LOOSE]])
        new.data |= written
        self._note_sizes(name, new, written)
        if writer:
            new.applied[writer[0]] = writer[1]
        self._publish(name, old, new)
        return count

    def drop(self, name: str) -> bool:
        """Delete the table's folder; whether there was a table."""
        known = self.exists(name)
        self._files.delete(f"{self.root}/{name}")
        return known

    # --- inside -----------------------------------------------------------------

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/current"

    def _version(self, name: str) -> _Version:
        if not self.exists(name):
            raise TableNotFound(f"{self.root}/{name}")
        return _Version(**json.loads(self._files.read_text(self._pointer(name))))

    @staticmethod
    def _next(old: _Version) -> _Version:
        """A version to be made from ``old``, with the data sets it has."""
        data = {bucket: [*sets] for bucket, sets in old.data.items()}
        return _Version(old.schema, old.keys, old.partition_by, old.buckets, data, dict(old.bytes), [], dict(old.applied))

    def _publish(self, name: str, old: _Version | None, new: _Version) -> None:
        kept = set(new.sets())
        new.before = [s for s in (old.sets() if old else []) if s not in kept]
        self._files.replace_text(self._pointer(name), json.dumps(asdict(new)))
        if old:
            self._delete(name, old.before, [*kept, *new.before])

    def _delete(self, name: str, sets: Iterable[str], kept: Iterable[str]) -> None:
        """Delete data sets, and the folder of the write that made them once nothing of it is kept."""
        used = {s.split("/")[0] for s in kept}
        for path in {s if s.split("/")[0] in used else s.split("/")[0] for s in sets}:
            self._files.delete(self._data_path(name, path))

    def _checked(self, name: str, written: dict[str, list[str]], rows: DataFrame, keys: Sequence[str]) -> int:
        """Row count of ``rows``; a repeated key takes back what was written."""
        try:
            return count_and_check(rows, keys)
        except ValueError:
            self._delete(name, [s for sets in written.values() for s in sets], [])
            raise

    def _size(self, name: str, data: str) -> int:
        return self._files.size(self._data_path(name, data))

    def _note_sizes(self, name: str, version: _Version, buckets: Iterable[str]) -> None:
        for bucket in buckets:
            version.bytes[bucket] = sum(self._size(name, s) for s in version.data[bucket])

    def _outgrown(self, version: _Version, more: int = 0) -> bool:
        """Whether the rows, with ``more`` bytes of them, are due to be dealt into more buckets, which happens
        once for every fourfold growth; the version then has as many. A table that is new is left as
        it was written: its first merge deals it, and no row is written for that alone."""
        held = more + sum(n for bucket, n in version.bytes.items() if bucket != _LOOSE)
        if self.buckets is not None or held <= 4 * version.buckets * BUCKET_BYTES or version.buckets >= MOST_BUCKETS:
            return False
        while version.buckets < MOST_BUCKETS and held > version.buckets * BUCKET_BYTES:
            version.buckets *= 2
        return True

    def _deal_anew(self, name: str, old: _Version, new: _Version) -> None:
        keyed = [b for b in new.data if b != _LOOSE]
        dealt = self._write(name, self._rows(name, new, keyed), new)
        made = [s for b in keyed for s in new.data[b] if s not in old.sets()]
        new.data = dealt | {b: s for b, s in new.data.items() if b == _LOOSE}
        new.bytes = {b: sum(self._size(name, s) for s in sets) for b, sets in new.data.items()}
        self._delete(name, made, [*new.sets(), *old.sets()])

    def _gathered(self, name: str, version: _Version, sets: list[str]) -> list[str]:
        """Data sets of rows with null keys; as one when there are many."""
        if len(sets) <= LOOSE_SETS:
            return sets
        rows = self._rows(name, _Version(version.schema, data={_LOOSE: sets}))
        return self._write(name, rows, version)[_LOOSE]

    def _data_path(self, name: str, data: str) -> str:
        return f"{self.root}/{name}/data/{data}"

    def _write(self, name: str, df: DataFrame, version: _Version) -> dict[str, list[str]]:
        """Write ``df``; the data sets made, by bucket. A bucket without rows gets none."""
        data = f"{_SET}={self._files._jvm.java.util.UUID.randomUUID().toString()}"
        path = self._data_path(name, data)
        if not version.keys:
            writer = df.write.partitionBy(*version.partition_by) if version.partition_by else df.write
            packed(writer).parquet(path)
            return {_WHOLE: [data]}
        dealt = df.withColumn(_BUCKET, _bucket(version))
        if version.buckets > 1:
            # Spark sees how large each bucket has become, and splits large ones among tasks.
            dealt = dealt.hint("rebalance", F.col(_BUCKET))
        packed(dealt.write.partitionBy(_BUCKET, *version.partition_by)).parquet(path)
        folders = [f for f in self._files.names(path) if f.startswith(f"{_BUCKET}=")]
        if not folders:
            self._files.delete(path)
        return {f.removeprefix(f"{_BUCKET}="): [f"{data}/{f}"] for f in folders}

    def _rows(self, name: str, version: _Version, buckets: Iterable[str] | None = None) -> DataFrame:
        """The rows of some buckets, or of all: one scan."""
        schema = T.StructType.fromJson(version.schema)
        chosen = version.data if buckets is None else buckets
        paths = [self._data_path(name, s) for b in chosen for s in version.data.get(b, [])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        scan = self.spark.read.schema(schema).option("basePath", self._data_path(name, "")).parquet(*paths)
        return scan.select(*[f"`{n}`" for n in schema.names])


def _bucket(version: _Version) -> Column:
    by_key = F.pmod(F.xxhash64(*[f"`{k}`" for k in version.keys]), F.lit(version.buckets))
    return F.when(all_present(version.keys), by_key).otherwise(int(_LOOSE)).cast("int")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
