"""Quality of documents by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics: sizes, word lengths,
shares of kinds of characters, repetition. Spark sums counts, vectors and
outer products of the labelled rows by class; from these come each class's
mean and its covariance, shrunk towards the diagonal. A score is the logistic
of the difference of the classes' log densities, whose Mahalanobis distances
use Cholesky factors that are computed once.

All labelled rows but the held-out fold are used; labels, language, source and
doc_id are never inputs of a score. Several labels of one doc_id count once
(the larger one). A null or empty text has statistics of its own, all zero. With
labels of one class, or none, every score is that class, or 0.5. A null doc_id
has no label and is not held out; repeated rows get one score. Empty tables
give empty results. Columns other than ``doc_id``, ``text`` and those named in
``carry`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopmill.llm.arrow import arrow_schema
from shopmill.llm.words import Texts, buffers, slices

SLICE = 1 << 20
#: Share of the diagonal in a class's covariance, and least variance of a standardised statistic.
SHRINKAGE, FLOOR = 0.1, 0.5
#: Scores from here on are label 1.
THRESHOLD = 0.3
SUMS = "quality int, at int, value double"


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    texts = Texts(column, lower=True)
    offsets, data = buffers(column)
    size, words = np.diff(offsets), texts.counts()

    def kinds(chosen: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(chosen[data], out=sums[1:])
        return sums[to] - sums[at]

    code = np.arange(256)
    digit, upper = (code >= 48) & (code <= 57), (code >= 65) & (code <= 90)
    letter = upper | ((code >= 97) & (code <= 122)) | (code > 127)
    mark = np.isin(code, list(b".,;:'\"-()?!"))
    symbol = (code > 32) & (code < 127) & ~digit & ~letter & ~mark
    per_byte = [kinds(k, offsets[:-1], offsets[1:]) / np.maximum(size, 1) for k in (upper, digit, mark, symbol, code > 127, code == 10)]
    loud = kinds(code == 33, offsets[:-1], offsets[1:]) / np.maximum(words, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return (sums[texts.first[1:]] - sums[texts.first[:-1]]) / np.maximum(words, 1)

    length = (texts.ends - texts.starts).astype(float)
    letters = kinds(letter, texts.starts, texts.ends)
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length**2) - mean**2, 0))
    again = np.zeros(len(texts.hashes))
    again[1:] = texts.hashes[1:] == texts.hashes[:-1]
    again[texts.first[:-1][words > 0]] = 0
    owners = np.repeat(np.arange(len(texts)), words)
    order = np.lexsort((texts.hashes, owners))
    new = np.ones(len(order), bool)
    new[1:] = (texts.hashes[order][1:] != texts.hashes[order][:-1]) | (owners[order][1:] != owners[order][:-1])
    distinct = np.bincount(owners[order][new], minlength=len(texts))
    columns = [
        np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread), *(np.sqrt(v) for v in per_byte), np.sqrt(loud),
        np.sqrt(per_word(letters == 0)), np.sqrt(per_word(again)), np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9),
        np.sqrt(per_word(upper[data[texts.starts]] if len(data) else again)),
    ]
    out = np.stack(columns, axis=1).astype(float)
    out[words == 0] = 0
    return out


@dataclass
class Discriminant:
    """Two Gaussian classes; factors are computed when a task unpacks the model."""

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: list[np.ndarray] = field(default_factory=list)
    covariances: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """How likely label 1 is, from 0 to 1."""
        if not self.means:
            return np.full(len(x), self.prior)
        if not hasattr(self, "factors"):
            self.factors = [np.linalg.cholesky(c) for c in self.covariances]
            self.inverses = [np.linalg.inv(f) for f in self.factors]
        x = (x - self.centre) / self.scale
        density = []
        for mean, factor, inverse in zip(self.means, self.factors, self.inverses):
            z = (x - mean) @ inverse.T
            density.append(-0.5 * (z * z).sum(axis=1) - np.log(np.diag(factor)).sum())
        logit = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    vectors = texts.mapInArrow(_measure, "doc_id long, x binary")
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"))
    known = known.where(~held_out())
    summed = vectors.join(known, "doc_id").select("quality", "x").mapInArrow(_sum, SUMS)
    # Bounded: two classes by the numbers of a mean and a covariance.
    classes: dict[int, dict[int, float]] = {}
    for row in summed.groupBy("quality", "at").agg(F.sum("value").alias("value")).collect():
        classes.setdefault(row.quality, {})[row.at] = row.value
    classes = {k: _split(np.array([v for _, v in sorted(own.items())])) for k, own in classes.items()}
    if len(classes) < 2:
        return Discriminant(float(next(iter(classes), 0.5)))
    n, sums, products = (classes[0][i] + classes[1][i] for i in range(3))
    centre = sums / n
    scale = np.sqrt(np.maximum(np.diag(products) / n - centre**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    model = Discriminant(classes[1][0] / n, centre, scale)
    for k in (0, 1):
        n, sums, products = classes[k]
        mean = sums / n
        covariance = (products / n - np.outer(mean, mean)) / np.outer(scale, scale)
        shrunk = (1 - shrinkage) * covariance + shrinkage * np.diag(np.diag(covariance))
        model.means.append((mean - centre) / scale)
        model.covariances.append(shrunk + FLOOR * np.eye(len(scale)))
    return model


def score(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD, carry: Sequence[str] = ()) -> DataFrame:
    """Documents with ``score`` and ``predicted``; ``text`` may be carried, too."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id bigint", *(f"`{c}` {kinds[c]}" for c in carry), "score double", "predicted int"])
    columns = dict.fromkeys(["doc_id", "text", *carry])
    return docs.select(*columns).mapInArrow(_scorer(model, threshold, tuple(carry)), schema)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, fit(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        x = [row.tobytes() for row in statistics(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.binary())], names=["doc_id", "x"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sum and sum of outer products of a task's vectors, by class, as numbered values."""
    classes: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        quality = batch.column("quality").to_numpy() > 0
        x = np.stack([np.frombuffer(v) for v in batch.column("x").to_pylist()])
        for k in (0, 1):
            own = x[quality == k]
            more = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            classes[k] = classes.get(k, 0) + more
    schema = arrow_schema(SUMS)
    for k, values in classes.items():
        if values[0]:
            columns = np.full(len(values), k), np.arange(len(values)), values
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _split(values: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, sum and sum of outer products from their numbered values."""
    d = int((np.sqrt(4 * len(values) - 3) - 1) / 2 + 0.5)
    return values[0], values[1 : d + 1], values[d + 1 :].reshape(d, d)


def _scorer(model: Discriminant, threshold: float, carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = model.scores(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *(batch.column(c) for c in carry), pa.array(found),
                    pa.array((found >= threshold).astype(np.int32)),
                ],
                names=["doc_id", *carry, "score", "predicted"],
            )

    return run
