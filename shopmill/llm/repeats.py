"""Removal of passages that already stand in a document with a smaller doc_id.

Every window of 50 consecutive words is hashed (Rabin-Karp); Spark deals the
hashes over buckets and counts them there. A window whose words also start in
a document with a smaller doc_id is marked, marked windows of a document are
merged into maximal intervals, and the words they cover are removed. Windows
are judged on the input, not on what is left.

Map tasks send one row per bucket and slice of texts, with the slice's window
hashes and places packed, so that a bucket's size follows the number of its
windows. Of equal windows in a slice one is sent, that of the smallest doc_id:
those of larger ones are marked there, and repeats within its own document
follow its mark. So a passage in a third of all documents, or one word repeated
over long texts, adds one entry per slice to each of its windows' buckets. A task
also remembers windows that came in several of its slices, a bounded number of
them: where an earlier slice sent one of a smaller doc_id, a later one marks its
own and sends none. So a hot window costs its bucket a few entries per task.

Two windows are taken for equal if two hashes are: one is sent, and one that
has nothing to do with it deals the buckets, so that the bits which must agree
grow with the corpus. Both are polynomials over a prime field; words enter them
by hashes of all their bytes.

Words are separated by space and the characters 9 to 13. A null or empty text
has no words and stays as it is; a text of fewer than 50 words has no window.
Rows with one doc_id never remove words of one another, so repeated rows stay
alike. A null doc_id counts as larger than all others. An empty table gives
an empty result. Columns other than ``doc_id``, ``text`` and those named in
``carry`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import store
from shopmill.llm.arrow import arrow_schema
from shopmill.llm.words import BASES, Texts, buffers, slices, windows

#: Words of a window.
WINDOW = 50
#: Bytes of text of one slice, and of packed windows in one bucket on average.
SLICE, BUCKET = 2 << 20, 8 << 20

#: Windows of earlier slices that a task remembers; those it forgets are sent again.
REMEMBERED = 1 << 18

#: A bucket's windows of a slice; or, with keys, the slice's documents and what the slice tells itself.
SENT = "slice long, bucket int, hashes binary, steps binary, sizes binary, doc_ids binary, keys binary, known binary"
MARKED = "slice long, places binary, sizes binary, doc_ids binary, keys binary, known binary"
CUTS = "doc_id long, key long, begins array<int>, ends array<int>"
NO_ID = np.iinfo(np.int64).max


def cuts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Intervals of words to remove, for each document that has any; ``key`` is the text's hash."""
    keyed = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("key"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total * 3 // 2 // BUCKET
    sent = keyed.mapInArrow(_sender(window, buckets), SENT)
    marked = store.deal(sent, buckets).mapInArrow(_marker, MARKED)
    found = marked.groupBy("slice").applyInArrow(_merger(window), CUTS)
    return store.settle(found.dropDuplicates(["doc_id", "key"]), "cuts", free=True)


def apply(docs: DataFrame, found: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The documents without the words that the intervals cover.

    ``text`` keeps the layout of what is left; ``kept_sha256`` is the hash of
    the words left, joined by one space.
    """
    keyed = docs.select("doc_id", "text", *carry, F.xxhash64("text").alias("key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.key") == F.col("c.key"))
    # The intervals grow with the corpus: never broadcast them.
    joined = keyed.join(found.hint("merge").alias("c"), same, "left").select("d.*", "c.begins", "c.ends").drop("key")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(
        ["doc_id bigint", "text string", *(f"`{c}` {kinds[c]}" for c in carry), "n_words bigint", "n_removed bigint", "kept_sha256 string"]
    )
    return joined.mapInArrow(_remover(tuple(carry)), schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    return apply(docs, cuts(docs, window), carry)


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def packed_steps(places: np.ndarray) -> bytes:
    """Ascending places as their differences, a byte each; 255 means that more follows."""
    steps = np.diff(places, prepend=0)
    more = steps // 255
    ends = np.cumsum(more + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = steps % 255
    return out.tobytes()


def places_of(steps: bytes) -> np.ndarray:
    steps = np.frombuffer(steps, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def runs(ordered: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of an ascending array, and where it stands."""
    heads = np.flatnonzero(np.diff(ordered.astype(np.int64), prepend=-1))
    for a, b in zip(heads, np.append(heads[1:], len(ordered))):
        yield int(ordered[a]), slice(int(a), int(b))


def _sender(window: int, buckets: int):
    schema = arrow_schema(SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, earlier = TaskContext.get().partitionId() << 32, Earlier(REMEMBERED)
        for batch in slices(batches, "text", SLICE):
            texts = Texts(batch.column("text"), lower=False)
            doc_ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            counts = texts.counts()
            hashes, second = (windows(texts.hashes, window, base) for base in BASES)
            left = np.repeat(texts.first[1:], counts)[: len(hashes)] - np.arange(len(hashes))
            places = np.flatnonzero(left >= window)
            hashes, second = hashes[places], second[places]
            owners = np.searchsorted(texts.first, places, "right") - 1
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            there = np.packbits(batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
            lead, marked, tied = _reduced(hashes, second, doc_ids[owners], earlier)
            known = np.concatenate([[marked.sum()], places[marked], places[lead[tied]], places[tied]]).astype("<u4")
            sent = ~(marked | tied)
            hashes, second, places, owners = hashes[sent], second[sent], places[sent], owners[sent]
            bucket = (second >> np.uint64(32)).astype(np.int64) * buckets >> 32
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            hashes, places, owners = hashes[order], places[order], owners[order]
            rows = []
            for b, own in runs(bucket[order]):
                heads = np.flatnonzero(np.diff(owners[own], prepend=-1))
                sizes = np.diff(heads, append=own.stop - own.start).astype("<u4")
                ids = doc_ids[owners[own][heads]]
                rows.append((number, b, hashes[own].tobytes(), packed_steps(places[own]), sizes.tobytes(), ids.tobytes(), None, None))
            own = (there.tobytes(), counts.astype("<u4").tobytes(), doc_ids.tobytes(), keys.tobytes(), known.tobytes())
            rows.append((number, number % buckets, None, *own))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            number += 1

    return run


class Earlier:
    """The least doc_id of windows that a task has met: those of the slice before, and those that came back.

    Of the latter, ``limit`` are kept; when there are more, those of the last slice.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.before = self.back = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def holds_smaller(self, hashes: np.ndarray, second: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
        """Whether each window, by ascending hash, has been met in a document of a smaller doc_id; they are met from now on."""
        least, met = doc_ids.copy(), np.zeros(len(hashes), bool)
        for known, other, ids in (self.before, self.back):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                same = (known[at] == hashes) & (other[at] == second)
                least[same] = np.minimum(least[same], ids[at[same]])
                met |= same
        self.before, again = (hashes, second, least), (hashes[met], second[met], least[met])
        # Of equal hashes the last slice's come first and stay.
        both = [np.concatenate(pair) for pair in zip(again, self.back)]
        _, first = np.unique(both[0], return_index=True)
        kept = first if len(first) <= self.limit else np.arange(min(len(again[0]), self.limit))
        self.back = tuple(values[kept] for values in both)
        return least < doc_ids


def _reduced(
    hashes: np.ndarray, second: np.ndarray, doc_ids: np.ndarray, earlier: Earlier
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window the first equal one of the smallest doc_id; whether its own is larger than that or an earlier slice's; whether it repeats that one."""
    order = np.lexsort((doc_ids, hashes))
    ordered = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    heads = order[new]
    lead = np.empty(len(hashes), np.int64)
    lead[order] = heads[np.cumsum(new) - 1]
    same, gone = second == second[lead], np.zeros(len(hashes), bool)
    gone[heads] = earlier.holds_smaller(hashes[heads], second[heads], doc_ids[heads])
    marked = same & (gone[lead] | (doc_ids > doc_ids[lead]))
    return lead, marked, same & ~marked & (lead != np.arange(len(hashes)))


def _view(value: pa.Scalar, kind) -> np.ndarray:
    """A binary value's numbers, not copied."""
    return np.frombuffer(value.as_buffer(), kind)


def _marker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the windows that also start in a document with a smaller doc_id, bucket by bucket."""
    schema = arrow_schema(MARKED)
    held, bucket = [], None
    for batch in batches:
        for i, (number, own) in enumerate(zip(batch.column("slice").to_pylist(), batch.column("bucket").to_pylist())):
            if not batch.column("hashes")[i].is_valid:
                row = (number, *(batch.column(c)[i].as_py() for c in ("steps", "sizes", "doc_ids", "keys", "known")))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)
                continue
            if own != bucket:
                yield from _marks(held, schema)
                held, bucket = [], own
            views = (_view(batch.column(c)[i], kind) for c, kind in (("hashes", np.uint64), ("doc_ids", np.int64), ("sizes", "<u4")))
            held.append((number, batch.column("steps")[i].as_py(), *views))
    yield from _marks(held, schema)


def _marks(held: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    hashes = np.concatenate([own for *_, own, _, _ in held])
    doc_ids = np.concatenate([np.repeat(ids, sizes) for *_, ids, sizes in held])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    heads = np.concatenate([[0], np.flatnonzero(hashes[1:] != hashes[:-1]) + 1])
    ordered = doc_ids[order]
    least = np.minimum.reduceat(ordered, heads)
    marks = np.zeros(len(hashes), bool)
    marks[order] = ordered > np.repeat(least, np.diff(heads, append=len(hashes)))
    cuts = np.cumsum([len(own) for *_, own, _, _ in held])[:-1]
    for (number, steps, *_), own in zip(held, np.split(marks, cuts)):
        if own.any():
            row = (number, places_of(steps)[own].astype("<u4").tobytes(), None, None, None, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _merger(window: int):
    schema = arrow_schema(CUTS)

    def run(table: pa.Table) -> pa.Table:
        """Merge a slice's marked windows into intervals of each of its documents."""
        rows = table.to_pydict()
        at = next(i for i, keys in enumerate(rows["keys"]) if keys is not None)
        doc_ids, keys = (np.frombuffer(rows[c][at], np.int64) for c in ("doc_ids", "keys"))
        there = np.unpackbits(np.frombuffer(rows["places"][at], np.uint8))
        first = np.concatenate([[0], np.cumsum(np.frombuffer(rows["sizes"][at], "<u4"), dtype=np.int64)])
        places = [np.frombuffer(p, "<u4") for i, p in enumerate(rows["places"]) if i != at]
        places = np.concatenate([np.zeros(0, "<u4"), *places])
        n, known = np.split(np.frombuffer(rows["known"][at], "<u4"), [1])
        marked, lead, tied = np.split(known, [n[0], n[0] + (len(known) - n[0]) // 2])
        places = np.sort(np.concatenate([places, marked, tied[np.isin(lead, places)]])).astype(np.int64)
        owners = np.searchsorted(first, places, "right") - 1
        new = np.ones(len(places), bool)
        new[1:] = (owners[1:] != owners[:-1]) | (places[1:] > places[:-1] + window)
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], len(places))[: len(begins)] - 1
        owner = owners[begins]
        begin, end = places[begins] - first[owner], places[ends] + window - first[owner]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        tails = np.append(heads[1:], len(owner))[: len(heads)]
        found = [
            (int(doc_ids[o]) if there[o] else None, int(keys[o]), begin[a:b], end[a:b])
            for o, a, b in zip(owner[heads], heads, tails)
        ]
        columns = zip(*found) if found else [[]] * len(schema)
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def _remover(carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            texts = Texts(batch.column("text"), lower=False)
            offsets, data = buffers(batch.column("text"))
            data, counts = data.tobytes(), texts.counts()
            kept, removed, digests = [], [], []
            for i, (begins, ends) in enumerate(zip(batch.column("begins").to_pylist(), batch.column("ends").to_pylist())):
                first, n = texts.first[i], int(counts[i])
                text, gone = data[offsets[i] : offsets[i + 1]], 0
                if begins:
                    # What is left: up to the first removed word, and from the next kept one on.
                    starts = texts.starts[first : first + n]
                    at, parts = offsets[i], []
                    for b, e in zip(begins, ends):
                        parts.append(data[at : starts[b]])
                        at = starts[e] if e < n else offsets[i + 1]
                        gone += e - b
                    text = b"".join([*parts, data[at : offsets[i + 1]]])
                kept.append(text)
                removed.append(gone)
                digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
            new = pa.array(kept, pa.binary(), mask=batch.column("text").is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), new.cast(pa.string()), *(batch.column(c) for c in carry),
                    pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
                ],
                names=["doc_id", "text", *carry, "n_words", "n_removed", "kept_sha256"],
            )

    return run
