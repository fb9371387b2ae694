"""Prefix trie of conversations, its totals passed up by time-forward processing."""

from __future__ import annotations

import heapq
import pickle
import struct
import uuid
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import ship_package, stage
from zonewright.session import work_folder

# Levels of the trie that one pass takes; deeper conversations are taken in several.
LEVELS = 1024
# Messages that a queue holds in memory, and those of a spilled run that are read at once.
QUEUE = 200_000
RUN_CHUNK = 4096
# Rows and characters that a task hands on at once.
ROWS = 20_000
BLOCK_CHARS = 64 * 1024

WIDTH = 16
ROOT = bytes(WIDTH)
_NODE = "level int, node binary, parent binary, chars long, n long, conv long, border boolean, children long, leaves long, saved long"


def next_node(node: bytes, turn: bytes) -> bytes:
    """The 128-bit name of the node that ``turn`` leads to from ``node``."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(node + turn)


def open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` of them in memory: when it has more, they go as
    a sorted run to ``folder``, the session's shared one, and come back in order, a chunk at a time."""

    def __init__(self, folder: str, limit: int = QUEUE) -> None:
        self._folder, self._limit = folder, limit
        self._heap: list[tuple] = []
        self._runs: list[tuple[tuple, int, Iterator[tuple]]] = []
        self._files: list[str] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._limit:
            self._spill()

    def _spill(self) -> None:
        name = f"{self._folder}/{uuid.uuid4().hex}"
        system, path = open_fs(name)
        self._heap.sort()
        with system.open_output_stream(path, compression=None) as out:
            for at in range(0, len(self._heap), RUN_CHUNK):
                data = pickle.dumps(self._heap[at : at + RUN_CHUNK], protocol=5)
                out.write(struct.pack("<Q", len(data)) + data)
        self._files.append(name)
        self._heap = []
        run = self._read(name)
        heapq.heappush(self._runs, (next(run), len(self._files), run))

    @staticmethod
    def _read(name: str) -> Iterator[tuple]:
        system, path = open_fs(name)
        with system.open_input_stream(path, compression=None) as file:
            while head := file.read(8):
                yield from pickle.loads(file.read(struct.unpack("<Q", head)[0]))

    def take(self, key: tuple) -> Iterator[tuple]:
        """All items that begin with ``key``, which is no larger than any other item's beginning."""
        size = len(key)
        while self._heap and self._heap[0][:size] == key:
            yield heapq.heappop(self._heap)
        while self._runs and self._runs[0][0][:size] == key:
            item, number, run = self._runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self._runs)
            else:
                heapq.heapreplace(self._runs, (following, number, run))
            yield item

    def __len__(self) -> int:
        return len(self._heap) + len(self._runs)

    def close(self) -> None:
        for name in self._files:
            system, path = open_fs(name)
            system.delete_file(path)
        self._files.clear()


def paths(
    turns: DataFrame, *, conv: str, turn: str, role: str, text: str, opening: tuple[int, int] | None, levels: int
) -> DataFrame:
    """``band, top, seg, chars, bottom, ends, conv``: every conversation as segments of at most
    ``levels`` turns. ``seg`` holds the turns' hashes one after the other, so that segments sort in the
    trie's own order; ``top`` and ``bottom`` are the nodes it leads from and to, ``ends`` tells the last one."""
    share, drawn = opening or (1, 1)
    own = F.col("c")
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    rows = rows.withColumn("g", own - own % share).withColumn("late", own != F.col("g"))
    # The conversation whose opening others take comes first of its group; then one after the other.
    rows = rows.repartition("g").sortWithinPartitions("g", "late", "c", F.asc_nulls_first("turn"), "role", "text")
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select(
        "g", "c", (F.crc32(F.encode(own.cast("string"), "UTF-8")) % drawn).cast("int").alias("h"),
        F.unhex(F.md5(F.encode(told, "UTF-8"))).alias("t"), F.length("text").alias("n"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        group = current = None
        shared: list[tuple[bytes, int]] = []
        skip = 0
        band, top, node, seg, chars = 0, ROOT, ROOT, bytearray(), []

        def ended(last: bool) -> None:
            out.append((band, top, bytes(seg), struct.pack(f"<{len(chars)}I", *chars), node, last, current))

        def walked(t: bytes, n: int) -> None:
            nonlocal band, top, node
            if len(chars) == levels:
                ended(False)
                band, top = band + 1, node
                seg.clear()
                chars.clear()
            seg.extend(t)
            chars.append(n)
            node = next_node(node, t)

        for batch in batches:
            for g, c, h, t, n in zip(batch["g"], batch["c"], batch["h"], batch["t"], batch["n"], strict=True):
                if c != current:
                    if current is not None:
                        ended(True)
                    if g != group:
                        group, shared = g, []
                    current, skip = c, h if c != g else 0
                    band, top, node, seg, chars = 0, ROOT, ROOT, bytearray(), []
                    if c != g:
                        for turn_ in shared[:h]:
                            walked(*turn_)
                if c == g and len(shared) < drawn - 1:
                    shared.append((t, n))
                if skip:
                    skip -= 1
                else:
                    walked(t, n)
            if len(out) >= ROWS:
                yield pd.DataFrame(out, columns=columns)
                out.clear()
        if current is not None:
            ended(True)
            yield pd.DataFrame(out, columns=columns)

    schema = "band int, top binary, seg binary, chars binary, bottom binary, ends boolean, conv long"
    columns = [f.split()[0] for f in schema.split(", ")]
    return rows.mapInPandas(cut, schema)


def shard_nodes(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The trie nodes of one shard, whose segments come sorted. ``n`` and ``conv`` are the count and the
    smallest of the shard's members. A shard is a stretch of the trie's own order, so only nodes on the
    path of its first or last segment (``border``) can have members or children in other shards."""
    columns = [f.split()[0] for f in _NODE.split(", ")]
    out: list[tuple] = []
    # From the top down: node, code points, members, smallest one, border, and what is known from below.
    stack: list[list] = []
    last_top, last = None, b""
    first = True

    def popped(border: bool) -> None:
        node, chars, n, conv, edge, below = stack.pop()
        if stack:
            over = stack[-1]
            over[2] += n
            over[3] = min(over[3], conv)
        out.append((len(stack), node, stack[-1][0] if stack else None, chars, n, conv, edge or border, *below))

    for batch in batches:
        for top, seg, chars, conv, n, *below in zip(*(batch[c] for c in ("top", "seg", "chars", "conv", "n", "children", "leaves", "saved")), strict=True):
            if top != last_top:
                while stack:
                    popped(False)
                stack.append([top, 0, 0, conv, first, (0, 0, 0)])
                same = 0
            else:
                same = _common(last, seg)
                while len(stack) > same + 1:
                    popped(False)
            lengths = struct.unpack(f"<{len(chars) // 4}I", chars)
            for i in range(same, len(lengths)):
                node = next_node(stack[-1][0], seg[i * WIDTH : (i + 1) * WIDTH])
                stack.append([node, lengths[i], 0, conv, first, (0, 0, 0)])
            stack[-1][2] += n
            stack[-1][3] = min(stack[-1][3], conv)
            stack[-1][5] = tuple(below)
            last_top, last, first = top, seg, False
            if len(out) >= ROWS:
                yield pd.DataFrame(out, columns=columns)
                out = []
    while stack:
        popped(True)
    if out:
        yield pd.DataFrame(out, columns=columns)


def _common(a: bytes, b: bytes) -> int:
    """Turns that two segments begin with alike."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * WIDTH] == b[: mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


def time_forward(folder: str, limit: int):
    """Totals of subtrees for nodes that come deepest first. A node takes what its children have sent it
    from the queue, and sends its own totals to its parent; a border node sends nothing and is handed on
    with what it has, as other shards know more of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in _NODE.split(", ")]
        queue = SpillingQueue(folder, limit)
        try:
            for batch in batches:
                out = []
                for level, node, parent, chars, n, conv, border, children, leaves, saved in zip(*(batch[c] for c in columns), strict=True):
                    for _, _, more_leaves, more_saved in queue.take((-level, node)):
                        children += 1
                        leaves += more_leaves
                        saved += more_saved
                    if not border:
                        leaves = leaves if children else 1
                        saved += (n - 1) * chars
                        if parent is not None:
                            queue.push((1 - level, parent, leaves, saved))
                    out.append((level, node, parent, chars, n, conv, border, children, leaves, saved))
                yield pd.DataFrame(out, columns=columns)
            if len(queue):
                raise RuntimeError("a node's parent was not in its shard")
        finally:
            queue.close()

    return run


def band_totals(segments: DataFrame, folder: str, queue: int) -> DataFrame:
    """Finished nodes of one band: first within shards, then across the shards' borders."""
    shards = segments.repartitionByRange("top", "seg").sortWithinPartitions("top", "seg")
    nodes = shards.mapInPandas(shard_nodes, _NODE).sortWithinPartitions(F.desc("level"), "node")
    within = stage(nodes.mapInPandas(time_forward(folder, queue), _NODE), "trie-within")
    # A shard has two border paths, so there are at most 2 * LEVELS + 2 border nodes for each.
    border = (
        within.where("border")
        .groupBy("level", "node", "parent", "chars")
        .agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
        .withColumn("border", F.lit(False))
        .select(*within.columns)
    )
    across = border.repartition(1).sortWithinPartitions(F.desc("level"), "node").mapInPandas(time_forward(folder, queue), _NODE)
    return within.where("not border").unionByName(across)


def joined_hashes(ends: DataFrame) -> DataFrame:
    """``node, sha`` from ``node, conv``: the SHA-256 of each node's numbers in order, joined by commas. The
    numbers are joined in blocks by many tasks; only the digest itself reads a node's blocks in a row."""

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        current, first, ids, held = None, 0, [], 0
        for batch in batches:
            for node, conv in zip(batch["node"], batch["conv"], strict=True):
                if node != current or held > BLOCK_CHARS:
                    if current is not None:
                        out.append((current, first, ",".join(ids)))
                    current, first, ids, held = node, conv, [], 0
                ids.append(str(conv))
                held += len(ids[-1]) + 1
            if len(out) >= ROWS:
                yield pd.DataFrame(out, columns=["node", "first", "ids"])
                out = []
        if current is not None:
            out.append((current, first, ",".join(ids)))
            yield pd.DataFrame(out, columns=["node", "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        current = digest = None
        for batch in batches:
            for node, ids in zip(batch["node"], batch["ids"], strict=True):
                if node != current:
                    if current is not None:
                        out.append((current, digest.hexdigest()))
                    current, digest = node, sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode("ascii"))
            if len(out) >= ROWS:
                yield pd.DataFrame(out, columns=["node", "sha"])
                out = []
        if current is not None:
            out.append((current, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["node", "sha"])

    blocks = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInPandas(joined, "node binary, first long, ids string")
    return blocks.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInPandas(hashed, "node binary, sha string")


def prefix_trie(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    opening: tuple[int, int] | None = None,
    levels: int = LEVELS,
    queue: int = QUEUE,
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: a row for
    every distinct beginning of the conversations in ``turns``, a row a turn, from the empty beginning on.

    A node is named by its smallest member, a conversation that begins with it, and its depth.
    ``n_leaves`` and ``saved_tokens`` are totals over its subtree, itself included: nodes without
    children, and for each node the code points of its last text that all members but one need not
    store again. ``ends_sha256`` is the digest of the members that end here.

    Distinct conversations are sorted and dealt into shards by ranges of the trie's own order, so that no
    beginning, however common, makes a shard large. Within a shard, nodes are sorted by reverse level
    order and send their totals to their parents through a priority queue that spills to the shared
    folder; nodes on a shard's borders are then finished across shards in the same way. Conversations
    of more than ``levels`` turns are taken in bands, the deepest first.

    Turns are in the order of ``turn`` (null first), equal ones in that of role and text. A null role or
    text is an empty one; a null conversation takes no part; other columns are not looked at; rows that
    repeat are turns each; no rows give no rows, not even the root. Conversations are whole numbers.

    With ``opening`` = (s, d), conversation c is given the first crc32(c) % d turns of conversation
    c - c % s in place of as many of its own; if that one is not there, it just loses its own.
    """
    spark = turns.sparkSession
    ship_package(spark)
    folder = work_folder(spark, "trie-queue")
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    found = stage(paths(turns, conv=conv, turn=turn, role=role, text=text, opening=opening, levels=levels), "trie-paths")
    # Equal conversations are one from here on; their count goes with them.
    segments = stage(
        found.groupBy("band", "top", "seg", "chars", "bottom").agg(F.min("conv").alias("conv"), F.count("*").alias("n")), "trie-segments"
    )
    deepest = segments.agg(F.max("band")).first()[0] or 0
    done, below = None, None
    for band in range(deepest, -1, -1):
        part = segments.where(F.col("band") == band)
        known = ["children", "leaves", "saved"]
        if below is None:
            part = part.withColumns({c: F.lit(0).cast("long") for c in known})
        else:
            part = part.join(below, "bottom", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in known})
        nodes = stage(band_totals(part.select("top", "seg", "chars", "conv", "n", *known), folder, queue), "trie-nodes")
        below = nodes.where("level = 0").select(F.col("node").alias("bottom"), *known)
        nodes = nodes.withColumn("depth", (F.col("level") + band * levels).cast("long"))
        nodes = nodes if band == 0 else nodes.where("level > 0")
        done = nodes if done is None else done.unionByName(nodes)
    ends = joined_hashes(found.where("ends").select(F.col("bottom").alias("node"), "conv"))
    # Lookup sides are dealt otherwise than the joins deal them, so that a node with very many children can be split.
    names = done.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    ends = ends.repartition(F.xxhash64(F.lit("deal"), "node"))
    return (
        done.join(names, "parent", "left")
        .join(ends, "node", "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("sha", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
