"""Packing of tokenized documents into sequences by best-fit decreasing.

Each document (its ids and the end id) is first cut into full windows, which
are sequences of their own, and a rest. The rests are dealt evenly over shards
of bounded size. A shard takes its rests longest first; a segment tree indexed
by remaining capacity finds the tightest open window that still holds each, or
a new one opens. Sequences are padded to the window, but for those whose
length is a power of two.

Null and empty texts are documents of the end id alone; repeated rows and rows
with one doc_id or none are documents of their own; an empty table gives no
sequences. Equally long rests go in the order of their row numbers. Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import store, tokens
from shopmill.llm.arrow import arrow_schema

WINDOW = 1024
#: Rests that one shard packs, on average; it holds their ids in memory.
SHARD_PIECES = 4096
TEXTS = 256

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary"
PACKED = (
    "sequence_id long, doc_ids array<long>, starts array<long>, lengths array<int>, doc_tokens array<long>,"
    " length int, padded int, ids binary"
)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree tells which capacities occur."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.stacks[capacity].append(sequence)
        self._count(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest window with at least this capacity, and its capacity."""
        capacity = self._first(need)
        if capacity is None:
            return None
        self._count(capacity, -1)
        return self.stacks[capacity].pop(), capacity

    def _count(self, capacity: int, change: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += change
            node >>= 1

    def _first(self, least: int) -> int | None:
        """The smallest occurring capacity from ``least`` on."""
        node = self.leaves + least
        while not self.tree[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Positions of the lengths by sequence; best fit, longest first."""
    windows, sequences = OpenWindows(window), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        if found := windows.take(lengths[i]):
            sequence, capacity = found
            sequences[sequence].append(i)
        else:
            sequence, capacity = len(sequences), window
            sequences.append([i])
        if capacity > lengths[i]:
            windows.add(capacity - lengths[i], sequence)
    return sequences


def padded_length(length: int, window: int = WINDOW) -> int:
    return length if length & (length - 1) == 0 else window


def pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Documents as full windows and rests, with their ids, written once; ``uid`` numbers them."""
    vocabulary = vocabulary or tokens.vocabulary()
    cut = docs.select("doc_id", "text").mapInArrow(_cutter(vocabulary, end_id, window), PIECES)
    return store.settle(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Sequences: their ids (little-endian unsigned 32-bit), pieces in order, and padded length."""
    vocabulary = vocabulary or tokens.vocabulary()
    cut = pieces(docs, vocabulary, end_id, window)
    full = F.col("length") == window
    rests = cut.where(~full)
    shards = 1 + rests.count() // SHARD_PIECES
    packer = _packer(vocabulary, window)
    shard = F.pmod(F.xxhash64("uid"), F.lit(shards))
    packed = rests.withColumn("shard", shard).groupBy("shard").applyInArrow(lambda table: packer(table, True), PACKED)
    return packed.unionByName(cut.where(full).mapInArrow(_each(packer), PACKED))


def digest(packed: DataFrame) -> DataFrame:
    """One row per piece, with a checksum of its ids as they stand in the sequence."""
    each = packed.select(
        "sequence_id", "ids", F.posexplode(F.arrays_zip("doc_ids", "starts", "lengths", "doc_tokens")).alias("at", "piece"),
        F.col("lengths").alias("all_lengths"),
    )
    before = F.aggregate(F.slice("all_lengths", 1, F.col("at")), F.lit(0), lambda a, x: a + x)
    placed = each.select("sequence_id", "ids", "piece.*", before.cast("long").alias("offset"))
    own = F.substring("ids", (4 * F.col("offset") + 1).cast("int"), 4 * F.col("lengths"))
    return placed.select(
        F.col("doc_ids").alias("doc_id"), F.col("starts").alias("start"), F.col("lengths").cast("long").alias("length"),
        F.crc32(own).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digest(pack(spark.read.parquet(f"{folder}/documents.parquet")))


def _cutter(vocabulary: str, end_id: int, window: int):
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        end, wide = np.asarray([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                rows = []
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = encoder.encode(text) + end
                    total = len(ids) // wide
                    for start in range(0, total, window):
                        own = ids[start * wide : (start + window) * wide]
                        rows.append((doc_id, start, len(own) // wide, total, own))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def _each(packer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from packer(pa.Table.from_batches([batch]), False).to_batches()

    return run


def _packer(vocabulary: str, window: int):
    schema = arrow_schema(PACKED)

    def run(table: pa.Table, shared: bool) -> pa.Table:
        """Pack a shard's rests together, or put each piece alone."""
        dtype = tokens.encoder(vocabulary).dtype
        table = table.sort_by("uid")
        rows = table.to_pydict()
        sequences = best_fit(rows["length"], window) if shared else [[i] for i in range(table.num_rows)]
        out = []
        for own in sequences:
            ids = np.frombuffer(b"".join(rows["ids"][i] for i in own), dtype)
            lengths = [rows["length"][i] for i in own]
            out.append(
                (
                    rows["uid"][own[0]], [rows["doc_id"][i] for i in own], [rows["start"][i] for i in own], lengths,
                    [rows["doc_tokens"][i] for i in own], len(ids), padded_length(len(ids), window), ids.astype("<u4").tobytes(),
                )
            )
        columns = zip(*out) if out else [[]] * len(schema)
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run
