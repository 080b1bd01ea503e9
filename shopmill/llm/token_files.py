"""Token-id files: whole documents as canonical Huffman codes in independent blocks.

A file set is a folder with two Parquet tables. ``codes`` has the code length
of each token id, from counts over all documents; the canonical code follows
from it. ``blocks`` has one row per block of whole documents: the number of
ids before it, its documents and their numbers of ids, the packed code words,
and a checkpoint (a bit offset) for every 256th id, from which decoding may
begin. No block needs another one.

Documents stand in ascending order of doc_id; a null doc_id comes first, rows
with one doc_id are ordered by the hash of their texts, and repeated rows are
kept. A null or empty text holds just the end id. An empty table gives an
empty file set. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import store, tokens
from shopmill.llm.arrow import arrow_schema
from shopmill.llm.huffman import Code, code_lengths

#: A block ends with the document that brings it to so many ids.
BLOCK_TOKENS = 1 << 16
#: Ids between two checkpoints.
EVERY = 256
#: Blocks that are decoded in one go.
BLOCKS = 16

PLAIN = "part int, before long, doc_ids array<long>, lengths array<long>, n_tokens long, ids binary, counts binary"
CODED = (
    "first_token long, doc_ids array<long>, lengths array<long>, n_tokens long, payload binary,"
    " checkpoints binary"
)
DECODED = "doc_id long, start long, n_tokens long, ids binary"


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0) -> None:
    """Write the documents' ids, each document closed by ``end_id``, to a new folder."""
    spark = docs.sparkSession
    vocabulary = vocabulary or tokens.vocabulary()
    tie = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    )
    plain = store.settle(ordered.mapInArrow(_tokenizer(vocabulary, end_id), PLAIN), "ids")
    counted = plain.select("counts").where("counts IS NOT NULL").mapInArrow(_counter, "id int, n long")
    blocks = plain.where("ids IS NOT NULL").drop("counts")
    counts = np.zeros(0, np.int64)
    # Bounded: one row per id of the vocabulary, one per partition.
    if rows := counted.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts = np.zeros(max(r.id for r in rows) + 1, np.int64)
        counts[[r.id for r in rows]] = [r.n for r in rows]
    lengths = code_lengths(counts)
    base, total = {}, 0
    for row in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        base[row.part], total = total, total + row.n
    codes = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(codes, "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")
    blocks.mapInArrow(_packer(lengths, base, vocabulary), CODED).write.parquet(f"{path}/blocks")
    store.drop(plain)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a file set: doc_id, start (ids of all documents before), n_tokens,
    and ids as little-endian unsigned 32-bit integers."""
    found = spark.read.schema("id int, bits int").parquet(f"{path}/codes").collect()
    lengths = np.zeros(max((r.id for r in found), default=-1) + 1, np.uint8)
    for row in found:
        lengths[row.id] = row.bits
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    return blocks.mapInArrow(_reader(lengths), DECODED)


def digest(df: DataFrame) -> DataFrame:
    """Per document its place and a checksum of its ids."""
    return df.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = store.new_path(spark, "token-files")
    write(spark.read.parquet(f"{folder}/documents.parquet"), path)
    return digest(read(spark, path))


def _tokenizer(vocabulary: str, end_id: int):
    schema = arrow_schema(PLAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of ids, and at the end how often the task met each id."""
        encoder = tokens.encoder(vocabulary)
        end, wide = np.asarray([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize
        part, before, n, counts = TaskContext.get().partitionId(), 0, 0, np.zeros(0, np.int64)
        ids, owners, lengths = [], [], []

        def block():
            nonlocal counts, before, n, ids, owners, lengths
            joined = b"".join(ids)
            more = np.bincount(np.frombuffer(joined, encoder.dtype), minlength=len(counts))
            more[: len(counts)] += counts
            row = (part, before, owners, lengths, n, joined, None)
            counts, before, n, ids, owners, lengths = more, before + n, 0, [], [], []
            return _row(row, schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(encoder.encode(text.as_py()) + end)
                owners.append(doc_id)
                lengths.append(len(ids[-1]) // wide)
                n += lengths[-1]
                if n >= BLOCK_TOKENS:
                    yield block()
        if owners:
            yield block()
        yield _row((part, before, None, None, 0, None, counts.astype("<i8").tobytes()), schema)

    return run


def _row(values: tuple, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, total = arrow_schema("id int, n long"), np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column(0):
            counts = np.frombuffer(counts.as_buffer(), "<i8")
            wider = np.zeros(max(len(total), len(counts)), np.int64)
            wider[: len(total)] += total
            wider[: len(counts)] += counts
            total = wider
    present = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), pa.array(total[present])], schema=schema)


def _packer(lengths: np.ndarray, base: dict[int, int], vocabulary: str):
    schema = arrow_schema(CODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, code = tokens.encoder(vocabulary).dtype, Code(lengths)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), dtype)
                payload, marks = code.encode(ids, EVERY)
                first = base[row.column("part")[0].as_py()] + row.column("before")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first]), row.column("doc_ids"), row.column("lengths"), row.column("n_tokens"),
                        pa.array([payload], pa.binary()), pa.array([marks.astype("<i8").tobytes()], pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _reader(lengths: np.ndarray):
    schema = arrow_schema(DECODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCKS):
                rows = batch.slice(at, BLOCKS).to_pydict()
                marks = [np.frombuffer(m, "<i8") for m in rows["checkpoints"]]
                ids = code.decode(rows["payload"], marks, rows["n_tokens"], EVERY)
                for first, owners, sizes, found in zip(rows["first_token"], rows["doc_ids"], rows["lengths"], ids):
                    ends = np.cumsum(sizes)
                    starts = ends - sizes
                    coded = found.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(owners, pa.int64()), pa.array(starts + first), pa.array(sizes, pa.int64()),
                            pa.array([coded[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                        ],
                        schema=schema,
                    )

    return run
