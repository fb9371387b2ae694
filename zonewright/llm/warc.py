"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from hashlib import sha1
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import small_batches, stage
from zonewright.session import work_folder

# Uncompressed bytes after which a frame ends, and compressed bytes after which a bundle does.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format and of the WARC standard.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_NAMES = uuid.UUID("6f7fdc60-6c55-4b8c-9b6c-0f3c1f3a7a11")
_INDEX = (
    "page_id string, record_id string, record_type string, bundle string, frame int, frame_start long, "
    "frame_offset long, length long"
)


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode("ascii")


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def render(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, digest: str) -> bytes:
    """One record; a revisit has the response's head and no payload."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode("ascii") + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        # No field may hold a line end; other characters of a URL stay as they are.
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-ID", refers_to)]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    size = int(fields["Content-Length"])
    return fields, data[start : start + size], start + size + 4


def open_fs(uri: str):
    """The file system of a path as the session names it, as seen from a Python worker."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class BundleWriter:
    """Whole records in independent frames, and the seek table as the last, skippable frame."""

    def __init__(self, folder: str, frame_bytes: int) -> None:
        # A repeated task writes another file; only files that the index names are ever read.
        self.name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = open_fs(self.name)
        self._out = system.open_output_stream(path, compression=None)
        self._frame_bytes = frame_bytes
        self._compress = zstandard.ZstdCompressor(level=LEVEL)
        self._frame = bytearray()
        self._table: list[tuple[int, int]] = []
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, where that frame begins, and where in it the record does."""
        if self._frame and len(self._frame) + len(record) > self._frame_bytes:
            self._end_frame()
        place = len(self._table), self.written, len(self._frame)
        self._frame += record
        return place

    def _end_frame(self) -> None:
        packed = self._compress.compress(bytes(self._frame))
        self._out.write(packed)
        self._table.append((len(packed), len(self._frame)))
        self.written += len(packed)
        self._frame.clear()

    def close(self) -> None:
        if self._frame:
            self._end_frame()
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self._table)
        footer = struct.pack("<IBI", len(self._table), 0, SEEKABLE)
        self._out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self._out.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """``(start, compressed, uncompressed)`` of every frame, from the end of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    frames, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    file.seek(size - 9 - frames * width)
    table, start = [], 0
    for entry in struct.iter_unpack(f"<{width // 4}I", file.read(frames * width)):
        table.append((start, entry[0], entry[1]))
        start += entry[0]
    return table


def read_record(bundle: str, frame: int, frame_offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry; only its frame is read and decompressed."""
    system, path = open_fs(bundle)
    with system.open_input_file(path) as file:
        start, packed, size = seek_table(file)[frame]
        file.seek(start)
        data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)
    fields, block, _ = parse(data, frame_offset)
    return fields, block


def with_responses(pages: DataFrame, *, min_bytes: int = 0, key: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` as ``page_id, url, html, refers_to`` (text, but for the url all not null but
    ``refers_to`` and null keys): ``refers_to`` is the smallest key with the same payload, for
    payloads of ``min_bytes`` and more, and null on that row itself."""
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html")))
    big = F.octet_length("html") >= min_bytes
    # One row for each payload that repeats. It comes dealt by something else than the
    # digest, so that the join below gets two exchanges of its own and a payload that a large
    # share of the pages has can be split.
    first = (
        rows.where(big)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
        .repartition("first")
    )
    return rows.join(first, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"),
    )


def write_bundles(
    rows: DataFrame, folder: str, *, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write what ``with_responses`` gives; returns the index, a row for each record. It is
    lazy: whoever writes the index writes the bundles, and what a lost task left is in no index."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, made = None, []

        def ended() -> pd.DataFrame:
            bundle.close()
            out = pd.DataFrame(made, columns=[f.split()[0] for f in _INDEX.split(", ")])
            made.clear()
            return out

        for batch in batches:
            for page, url, html, refers in zip(
                batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True
            ):
                if bundle is None:
                    bundle = BundleWriter(folder, frame_bytes)
                payload = html.encode("utf-8")
                digest = bare_digest(payload)
                record = render(page, url, payload, refers, digest)
                kind = "response" if refers is None else "revisit"
                frame, start, offset = bundle.add(record)
                made.append((page, record_id(page, digest), kind, bundle.name, frame, start, offset, len(record)))
                if bundle.written >= bundle_bytes:
                    yield ended()
                    bundle = None
        if bundle is not None:
            yield ended()

    small_batches(rows.sparkSession)
    return rows.mapInPandas(write, _INDEX)


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, read frame by frame from the files:
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` with the keys as
    text. A response's digest is that of the payload read; a wrong one is an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch["bundle"]:
                system, path = open_fs(name)
                with system.open_input_file(path) as file:
                    for start, packed, size in seek_table(file):
                        file.seek(start)
                        data = unpack.decompress(file.read(packed), max_output_size=size)
                        out, at = [], 0
                        while at < len(data):
                            fields, block, at = parse(data, at)
                            head, _, payload = block.partition(b"\r\n\r\n")
                            told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            if fields["WARC-Type"] == "response" and bare_digest(payload) != told:
                                raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not what was written")
                            out.append(
                                (
                                    fields.get("Page-ID"), fields.get("WARC-Target-URI"),
                                    int(head.rsplit(b"Content-Length: ", 1)[1]), told,
                                    fields["WARC-Type"], fields.get("Refers-To-Page-ID"),
                                )
                            )
                        yield pd.DataFrame(
                            out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                        )

    bundles = index.select("bundle").distinct()
    # A task for each bundle or few: Spark would put so small a table into one task.
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInPandas(
        read,
        "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string",
    )


def archive(
    pages: DataFrame, *, folder: str | None = None, min_bytes: int = 0, key: str = "page_id", html: str = "html"
) -> tuple[DataFrame, DataFrame]:
    """Write ``pages`` as WARC bundles below ``folder`` (a new one in the session's shared
    folder unless given). Returns the index and what the bundles hold when read back, the
    latter with ``key`` and ``refers_to`` in the key's type.

    Of rows with equal payloads of ``min_bytes`` and more, the one with the smallest key is a
    response and the others revisit it. A null html is an empty payload. Rows that repeat the
    smallest key are responses too; a null key is never the smallest, and rows with null keys
    only are all responses. A null url is left out; control and non-ASCII characters of a
    url are percent-encoded. No rows give no bundles. Other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "warc")
    system_made = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system_made.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(system_made)
    rows = with_responses(pages, min_bytes=min_bytes, key=key, html=html)
    index = stage(write_bundles(rows, folder), "warc-index")
    kind = pages.schema[key].dataType
    records = read_bundles(index)
    return index, records.select(
        F.col("page_id").cast(kind).alias(key),
        "url", "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
