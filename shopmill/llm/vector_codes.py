"""Vector codes by product quantization in exact integers.

Components become integers ``floor(4096 x)``; vectors are cut into 8 equal
consecutive parts. Each part position has a codebook of at most 16 entries, at
first the parts of the smallest vec_ids. Each round assigns all parts to their
nearest entries (squared distance, ties to the lower index) and replaces an
entry by its parts' componentwise floor of the mean; unused ones stay.

Distances need inner products of integers, which BLAS has in float64 only. So
integers are broken into limbs of as many bits as keep every sum of a product of
limb matrices below 2^53; the products are exact then, and are put together in
int64 with shifts. All distances fit int64, so the first argmin is the true one.

Tasks sum the parts of each entry, Spark adds the tasks' sums, and the driver
gets the sums of 8 x 16 entries per length of vectors. The integers are written
once and read in each round.

Rows whose vector is null or holds null or non-finite components are left out.
Vectors of one length have codebooks of their own; where 8 does not divide the
length, zeros fill the last part, and empty vectors have code 0 and error 0.
Of rows that share a vec_id the one of the smallest bytes gives the entry; a
null vec_id comes after all others. With fewer than 16 ids there are fewer
entries. Equal rows get equal codes. Components beyond what keeps distances of a part
below 2^63 (131,072 in parts of 8) count as that bound; sums of errors beyond
a long as the largest long. Empty tables give empty results. Other columns than ``vec_id``,
``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopmill.llm import store
from shopmill.llm.arrow import arrow_schema
from shopmill.llm.words import buffers

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

KEPT = "vec_id long, dim int, numbers binary"
SEEDS = "dim int, vec_id long, numbers binary"
SUMS = "dim int, part int, entry int, place int, value long"
CODED = "vec_id long, dim int, code string, error long, codebooks_sha256 string"

LARGEST = np.iinfo(np.int64).max
#: Codebooks by length of vectors: (parts, entries, width).
Books = dict[int, np.ndarray]


def width(dim: int) -> int:
    """Components of a part."""
    return -(-dim // PARTS)


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs of ``bits`` bits, lowest first; the highest one has the sign."""
    out = []
    while values.size and max(int(values.max()), -int(values.min())) >> bits:
        out.append((values & ((1 << bits) - 1)).astype(float))
        values = values >> bits
    return [*out, values.astype(float)]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right`` of int64 matrices, exact if it fits int64."""
    bits = (53 - int(left.shape[-1]).bit_length()) // 2
    out = np.zeros((*left.shape[:-1], right.shape[-1]), np.int64)
    low = limbs(right, bits)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(low):
            if bits * (i + j) < 64:  # further ones are multiples of 2^64
                out += np.matmul(a, b).astype(np.int64) << (bits * (i + j))
    return out


def assign(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries of parts (position, row, component) and the squared distances to them."""
    cross = products(parts, book.transpose(0, 2, 1))
    away = (parts * parts).sum(axis=2)[:, :, None] - 2 * cross + (book * book).sum(axis=2)[:, None, :]
    nearest = away.argmin(axis=2)
    return nearest, np.take_along_axis(away, nearest[:, :, None], axis=2)[:, :, 0]


def _positions(numbers: np.ndarray, dim: int) -> np.ndarray:
    """Rows of integers as (position, row, component)."""
    wide = np.zeros((len(numbers), PARTS * width(dim)), np.int64)
    wide[:, :dim] = numbers
    return np.ascontiguousarray(wide.reshape(len(numbers), PARTS, -1).transpose(1, 0, 2))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vectors the batch's rows with it, and their integers."""
    offsets, data = buffers(batch.column("numbers"))
    data, dims = np.frombuffer(data, "<i4"), batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        at = (offsets[rows] // 4)[:, None] + np.arange(dim)
        yield dim, rows, data[at]


def integers(embeddings: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows that take part, with their components as integers, written."""
    schema = ", ".join([KEPT, *(f"`{c}` {dict(embeddings.dtypes)[c]}" for c in carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            there = lists.is_valid().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.where(there, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0))
            flat = lists.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(float)
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            kept = np.flatnonzero(there & (bad[ends] == bad[begins]))
            numbers = []
            for i in kept:
                dim = int(ends[i] - begins[i])
                most = isqrt(LARGEST // (4 * max(1, width(dim))))
                with np.errstate(over="ignore"):
                    numbers.append(np.clip(np.floor(SCALE * values[begins[i] : ends[i]]), -most, most).astype("<i4").tobytes())
            chosen = batch.take(pa.array(kept))
            columns = [chosen.column("vec_id"), pa.array(ends[kept] - begins[kept], pa.int32()), pa.array(numbers, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(chosen.column(c) for c in carry)], names=["vec_id", "dim", "numbers", *carry])

    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), *carry)
    return store.settle(rows.mapInArrow(run, schema), "integers")


def first_books(kept: DataFrame, entries: int = ENTRIES) -> Books:
    """The parts of the smallest vec_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, dict] = defaultdict(dict)
        for batch in batches:
            for vec_id, dim, numbers in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dim", "numbers"))):
                own, key = least[dim], (vec_id is None, vec_id or 0)
                if key in own or len(own) < entries or key < max(own):
                    own[key] = min(numbers, own.get(key, numbers))
                    if len(own) > entries:
                        del own[max(own)]
        rows = [(dim, None if none else vec_id, numbers) for dim, own in least.items() for (none, vec_id), numbers in own.items()]
        if rows:
            yield _batch(rows, SEEDS)

    seeds = kept.select("vec_id", "dim", "numbers").mapInArrow(run, SEEDS)
    seeds = seeds.groupBy("dim", "vec_id").agg(F.min("numbers").alias("numbers"))
    order = Window.partitionBy("dim").orderBy(F.asc_nulls_last("vec_id"))
    chosen = seeds.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= entries)
    by_dim: dict[int, list] = defaultdict(list)
    for row in chosen.orderBy("dim", "rank").collect():
        by_dim[row.dim].append(np.frombuffer(bytes(row.numbers), "<i4"))
    return {dim: _positions(np.array(own).reshape(len(own), dim), dim) for dim, own in by_dim.items()}


def improved(kept: DataFrame, books: Books) -> Books:
    """The codebooks after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {dim: np.zeros((*book.shape[:2], book.shape[2] + 1), np.int64) for dim, book in books.items()}
        for batch in batches:
            for dim, _, numbers in _by_dim(batch):
                parts, own = _positions(numbers, dim), sums[dim]
                nearest, _ = assign(parts, books[dim])
                for position in range(PARTS):
                    order = np.argsort(nearest[position], kind="stable")
                    used, heads = np.unique(nearest[position][order], return_index=True)
                    if parts.shape[2]:
                        own[position, used, :-1] += np.add.reduceat(parts[position][order], heads, axis=0)
                    own[position, used, -1] += np.diff(heads, append=len(order))
        for dim, own in sums.items():
            place = np.indices(own.shape).reshape(3, -1).astype(np.int32)
            columns = [np.full(own.size, dim, np.int32), *place, own.reshape(-1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow_schema(SUMS))

    sums = kept.select("dim", "numbers").mapInArrow(run, SUMS)
    # 8 x 16 entries for each length of vectors.
    found = sums.groupBy("dim", "part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    by: dict[tuple[int, int, int], dict[int, int]] = defaultdict(dict)
    for row in found:
        by[row.dim, row.part, row.entry][row.place] = int(row.value)
    after = {dim: book.copy() for dim, book in books.items()}
    for (dim, part, entry), own in by.items():
        size = after[dim].shape[2]
        if own[size]:
            after[dim][part, entry] = [own[i] // own[size] for i in range(size)]
    return after


def coded(kept: DataFrame, books: Books, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's code, its error, and the hash of the codebooks."""
    names = {dim: hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest() for dim, book in books.items()}
    kinds = dict(kept.dtypes)
    schema = ", ".join([CODED, *(f"`{c}` {kinds[c]}" for c in carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = np.empty(batch.num_rows, object), np.zeros(batch.num_rows, np.int64)
            for dim, rows, numbers in _by_dim(batch):
                nearest, away = assign(_positions(numbers, dim), books[dim])
                text = nearest.T.astype(np.uint8).tobytes().hex()
                codes[rows] = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
                for own in away:
                    errors[rows] += np.minimum(own, LARGEST - errors[rows])
            dims = batch.column("dim")
            own = [batch.column("vec_id"), dims, pa.array(codes, pa.string()), errors, pa.array([names[d] for d in dims.to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) if isinstance(c, np.ndarray) else c for c in own] + [batch.column(c) for c in carry],
                names=["vec_id", "dim", "code", "error", "codebooks_sha256", *carry],
            )

    return kept.mapInArrow(run, schema)


def compress(embeddings: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, carry: tuple[str, ...] = ()) -> tuple[DataFrame, Books]:
    """Codes of all rows that take part, written, and the codebooks."""
    kept = integers(embeddings, carry)
    books = first_books(kept, entries)
    for _ in range(rounds):
        books = improved(kept, books)
    return store.settle(coded(kept, books, carry), "codes"), books


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = compress(spark.read.parquet(f"{folder}/embeddings.parquet"), carry=("label",))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(int(LARGEST)).cast("decimal(38,0)")).cast("long")
    per = store.settle(found.groupBy(F.col("label").alias("own")).agg(total.alias("label_error")), "label-errors")
    joined = found.join(per, F.col("label").eqNullSafe(F.col("own")))
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _statement() -> str:
    parts = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""parts AS MATERIALIZED (
    SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS w FROM kept, range({PARTS}) AS t(p)
)""",
        f"""book0 AS MATERIALIZED (
    SELECT p, n AS e, w FROM parts
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM kept ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)
)""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"""near{i} AS MATERIALIZED (
    SELECT vec_id, label, p, w, min(row(d, e)) AS best FROM (
        SELECT a.*, e, CAST(list_sum(list_transform(list_zip(a.w, b.w), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d
        FROM parts a JOIN book{i} b USING (p)
    ) GROUP BY vec_id, label, p, w
)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""book{i + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(n.w, b.w) AS w FROM book{i} b LEFT JOIN (
        SELECT p, e, list(x ORDER BY k) AS w FROM (
            SELECT p, e, k, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
            FROM (SELECT p, best[2] AS e, unnest(w) AS x, unnest(range(len(w))) AS k FROM near{i}) GROUP BY p, e, k
        ) GROUP BY p, e
    ) n USING (p, e)
)"""
            )
    return (
        "WITH " + ", ".join(parts) + f""", coded AS (
    SELECT vec_id, label, string_agg(lpad(printf('%x', best[2]), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded
"""
    )


STATEMENT = _statement()
