"""Search of documents for passages of a benchmark, by Wu-Manber over words.

Texts are lower-cased (A to Z) and cut into words of digits, letters and
characters beyond ASCII. The patterns are all windows of ten consecutive words
of the items; an item of fewer words is one pattern. Patterns of one length
are searched together: a shift table of two-word blocks says how far the search
may go on, a block that ends a pattern selects a bucket of patterns, and direct
comparison confirms an occurrence.

The benchmark is a stated query set. It is given to every task in parts of
bounded size; of several parts each is one pass over the documents, written to
the shared folder before the next. Rows are dealt to parts by their measured
size, whatever their item_id, and a large text is cut into runs of words that
overlap by all but one word of a window. A null or empty text has no words. An item
without item_id takes no part, rows with one item_id are one item, and repeated
documents are judged alike. Empty tables give no hits or no rows. Columns
other than ``doc_id``, ``text``, ``item_id`` and those named in ``carry`` are
not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import store
from shopmill.llm.arrow import arrow_schema

WINDOW = 10
#: Bytes of benchmark text that a task holds at a time; its tables take some 80 times as much memory.
PART = 8 << 20
#: A part's rows, placed by the bytes before them in their task.
PIECES = "item string, text binary, task int, place long"
#: Every byte that parts words becomes a blank, A to Z their small letters.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def pieces(text: bytes, window: int, size: int) -> Iterator[bytes]:
    """A text's words in runs of ``size`` bytes, or two windows of longer words; each window is in one of them."""
    words = re.sub(rb" +", b" ", text.translate(FOLD)).strip()
    at = 0
    while at < len(words):
        end = at
        for _ in range(2 * window):
            end = words.find(b" ", end + 1)
            if end < 0:
                break
        if 0 <= end < at + size:
            end = words.find(b" ", at + size)
        if end < 0:
            yield words[at:]
            return
        yield words[at:end]
        at = end
        for _ in range(window - 1):
            at = words.rfind(b" ", 0, at)
        at += 1


class WuManber:
    """Occurrences of patterns of one length, each a run of words with its item, or items."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], str | set[str]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.patterns, self.known = patterns, set[bytes]()
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = defaultdict(list)
        for words in patterns:
            self.known.update(words)
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.default), length - end)
            self.buckets[words[-self.block :]].append(words)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, str | set[str]]]:
        """Where an occurrence begins, and whose it is."""
        length, size, known, shift = self.length, self.block, self.known, self.shift
        at, n = length - 1, len(words)
        while at < n:
            if words[at] not in known:
                at += length
                continue
            block = tuple(words[at - size + 1 : at + 1])
            step = shift.get(block, self.default)
            if step:
                at += step
                continue
            begin = at - length + 1
            window = tuple(words[begin : at + 1])
            for pattern in self.buckets[block]:
                if window == pattern:
                    yield begin, self.patterns[pattern]
            at += 1


class Patterns:
    """All windows of some items, by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        by_length: dict[int, dict[tuple[bytes, ...], str | set[str]]] = defaultdict(dict)
        for item, text in items:
            words = words_of(text)
            length = min(window, len(words))
            for begin in range(len(words) - length + 1 if length else 0):
                run, known = tuple(words[begin : begin + length]), by_length[length]
                # Most windows are of one item: a set for each would take much of the memory.
                own = known.setdefault(run, item)
                if isinstance(own, set):
                    own.add(item)
                elif own != item:
                    known[run] = {own, item}
        self.machines = [WuManber(length, found) for length, found in by_length.items()]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Intervals of words inside occurrences, as they are met, and the items."""
        hits, items = [], set()
        for machine in self.machines:
            for begin, own in machine.search(words):
                items |= {own} if isinstance(own, str) else own
                if hits and hits[-1][1] >= begin >= hits[-1][0]:
                    hits[-1] = (hits[-1][0], max(hits[-1][1], begin + machine.length))
                else:
                    hits.append((begin, begin + machine.length))
        return hits, items


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """Documents with ``n_words``, the intervals of words inside occurrences, and the items, sorted."""
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND octet_length(text) > 0").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
    )
    parts = _parts(items, window)
    kinds = dict(docs.dtypes)
    schema = ", ".join(
        ["doc_id bigint", "text string", *(f"`{c}` {kinds[c]}" for c in carry),
         "n_words bigint", "begins array<int>", "ends array<int>", "items array<string>"]
    )
    none = [F.lit(None).cast(t).alias(c) for c, t in (("begins", "array<int>"), ("ends", "array<int>"), ("items", "array<string>"))]
    found = docs.select("doc_id", "text", *carry, F.lit(0).cast("long").alias("n_words"), *none)
    for number, part in enumerate(parts, 1):
        shared = spark.sparkContext.broadcast([(r.item, bytes(r.text)) for r in part.collect()])
        found = found.mapInArrow(_finder(shared, window, tuple(carry)), schema)
        if number < len(parts):
            found = store.settle(found, "hits")
    return found


def digest(found: DataFrame) -> DataFrame:
    lengths = F.zip_with("begins", "ends", lambda a, b: (b - a).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return digest(find(docs, benchmark))


def _parts(items: DataFrame, window: int) -> list[DataFrame]:
    """The items by parts: each holds PART bytes and at most one piece more."""
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    if size <= PART:
        return [items]
    cut = store.settle(items.mapInArrow(_cutter(window, PART), PIECES), "benchmark")
    # One row per task on the driver: a part begins at the piece that is next after so many bytes.
    end = F.max(F.col("place") + F.octet_length("text") + F.octet_length("item"))
    at, total, bounds = F.struct("task", "place"), 0, []
    for task, own in sorted(cut.groupBy("task").agg(end).collect()):
        while len(bounds) * PART < total + own:
            bounds.append(F.struct(F.lit(task), F.lit(len(bounds) * PART - total).cast("long")))
        total += own
    parts = [cut.where((at >= a) & (at < b)) for a, b in zip(bounds, bounds[1:])]
    return [*parts, cut.where(at >= bounds[-1]) if bounds else cut]


def _cutter(window: int, part: int):
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place, begin, rows = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                for piece in pieces(text.as_py(), window, part // 8):
                    rows.append((item, piece, task, place))
                    place += len(piece) + len(item.encode())
                    if place - begin >= part:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        begin, rows = place, []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(hits):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _finder(shared, window: int, carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(shared.value, window)
        for batch in batches:
            counts, begins, ends, items = [], [], [], []
            before = zip(*(batch.column(c).to_pylist() for c in ("begins", "ends", "items")))
            for text, (old_begins, old_ends, old_items) in zip(batch.column("text").cast(pa.binary()), before):
                words = words_of(text.as_py())
                hits, own = patterns.search(words)
                hits = _merged([*zip(old_begins or (), old_ends or ()), *hits])
                counts.append(len(words))
                begins.append([a for a, _ in hits])
                ends.append([b for _, b in hits])
                items.append(sorted(own.union(old_items or ())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text"), *(batch.column(c) for c in carry), pa.array(counts, pa.int64()),
                    pa.array(begins, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text", *carry, "n_words", "begins", "ends", "items"],
            )

    return run
