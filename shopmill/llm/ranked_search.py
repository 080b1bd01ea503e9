"""Ranked lexical search of all documents for each item of a query set.

Terms are runs of digits, letters and characters beyond ASCII, A to Z
lower-cased. A document's score is the sum over an item's terms, repeats
included, of ``weight * saturated frequency``, all in integers (see ``search``).

1. Tasks turn the documents into shards of some 4 MB of text, written to the
   shared folder: for each query term of the shard the documents that hold it
   and how often, and how long these are. Numbers of documents and terms, and how many
   documents hold each query term, are summed in Spark.
2. A task searches its shards one after another and keeps each item's best
   documents so far. Within a shard a search is a hybrid. The item's short lists
   are read term at a time, into one sorted list of summed accumulators. That list
   is then one iterator, with its largest sum as bound, among the long lists,
   which are merged document at a time, a range of documents together: iterators
   whose bounds together cannot reach an item's last rank give no candidates;
   they are only probed, by binary search, for candidates that could still
   reach it.
3. Of the tasks' best the best are ranked in Spark.

The items are a stated query set. Their terms go to every task in parts of
bounded size (8 MB, and one item's distinct terms at most beyond); each part
is one pass. A task holds a shard and the best documents of a part's items.
Long texts are cut into words section by section.

A null or empty text has no terms and is found for no item. Documents without
doc_id are found like others and come last among equal scores. Repeated rows
are documents of their own. An item without item_id takes no part; equal
rows of items count once, and different texts of one item_id are one item.
An item without terms, or whose terms no document holds, has no rows. Empty tables
give empty results. Other columns than ``doc_id``, ``text`` and ``item_id`` are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopmill.llm import store
from shopmill.llm.arrow import arrow_schema
from shopmill.llm.decontaminate import FOLD
from shopmill.llm.ordered import running

BEST = 20
#: A document's length counts a quarter, its share of the mean length three quarters of a whole (percent).
LENGTH_SHARE = 25
#: Bytes of text of a shard, bytes of words that are cut at a time, bytes of items' terms in a task.
SHARD, SECTION, PART = 4 << 20, 1 << 20, 8 << 20
#: Entries of an item's shortest lists in a shard that are summed before the others are merged.
SHORT = 1024
#: Documents of the first range while an item has too few results; each range is twice the one before.
RANGE = 64

TERMS = "item string, term binary, times long"
SHARDS = "docs long, words long, terms binary, sizes binary, owners binary, times binary, doc_ids binary, lengths binary"
HELD = "term int, docs long"
FOUND = "item string, doc_id long, score long"
NO_ID = np.iinfo(np.int64).max


def sections(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + SECTION)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


@dataclass
class Queries:
    """Items and their terms by number, as every task gets them."""

    items: list[str]
    terms: dict[bytes, int]
    #: Per item its terms' numbers and how often each stands in it.
    wanted: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list) -> Queries:
        terms: dict[bytes, int] = {}
        by_item: dict[str, dict[int, int]] = {}
        for item, term, times in rows:
            by_item.setdefault(item, {})[terms.setdefault(bytes(term), len(terms))] = times
        wanted = [(np.array(list(own), np.int64), np.array(list(own.values()), np.int64)) for own in by_item.values()]
        return cls(list(by_item), terms, wanted)


def weight(docs: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * held + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term, times`` for each item and distinct term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(TERMS)
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                for words in sections(text.as_py()):
                    found = Counter(words)
                    columns = [pa.array([item] * len(found)), pa.array(found, pa.binary()), pa.array(found.values(), pa.int64())]
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)

    known = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    cut = known.select("item", F.col("text").cast("binary").alias("text")).mapInArrow(run, TERMS)
    return store.settle(cut.groupBy("item", "term").agg(F.sum("times").alias("times")), "item-terms")


def parts(terms: DataFrame) -> list[DataFrame]:
    """The items' terms in parts of some PART bytes; an item's terms are in one part."""
    size = F.octet_length("term") + F.octet_length("item") + 16
    if (terms.agg(F.sum(size)).first()[0] or 0) <= PART:
        return [terms]
    per = terms.groupBy("item").agg(F.sum(size).alias("bytes"))
    placed = running(per, [F.col("item")], before=F.col("bytes"))
    placed = store.settle(terms.join(placed.select("item", F.expr(f"before div {PART}").alias("part")), "item"), "item-parts")
    return [placed.where(F.col("part") == r.part).drop("part") for r in placed.select("part").distinct().orderBy("part").collect()]


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    With N documents that have terms, L terms in all, n in a document and tf of
    one of them, df documents holding it, w = floor(1000 ln((2N+2)/(2df+1))) and
    m = 75 + 25nN div L, a term gives w * (10^9 tf div (1000 tf + 12 m)).
    """
    spark = docs.sparkSession
    best = None
    for part in parts(item_terms(items)):
        queries = spark.sparkContext.broadcast(Queries.of([tuple(r) for r in part.collect()]))
        if not queries.value.items:
            continue
        shards = store.settle(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_indexer(queries), SHARDS), "shards")
        n, words = (x or 0 for x in shards.agg(F.sum("docs"), F.sum("words")).first())
        held = shards.select("terms", "sizes").mapInArrow(_holders(queries), HELD).groupBy("term").agg(F.sum("docs").alias("docs"))
        weights = np.zeros(len(queries.value.terms), np.int64)
        for row in held.collect():  # distinct terms of a part
            weights[row.term] = weight(n, row.docs)
        found = shards.mapInArrow(_searcher(queries, spark.sparkContext.broadcast(weights), n, words, k), FOUND)
        found = store.settle(found, "found")
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").cast(dict(items.dtypes)["item_id"]).alias("item_id"), "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


def _indexer(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, shard, size = queries.value.terms.get, _Shard(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                text, n, found = text.as_py(), 0, Counter()
                for words in sections(text):
                    n += len(words)
                    found.update(map(get, words))
                found.pop(None, None)
                shard.add(doc_id, n, found)
                size += len(text)
                if size >= SHARD:
                    yield shard.row()
                    shard, size = _Shard(), 0
        if shard.docs:
            yield shard.row()

    return run


class _Shard:
    """Documents of a shard, and where query terms stand in them."""

    def __init__(self):
        self.docs = self.words = 0
        self.doc_ids, self.lengths, self.terms, self.owners, self.times = [], [], [], [], []

    def add(self, doc_id: int | None, n: int, found: Counter) -> None:
        self.docs += n > 0
        self.words += n
        if found:
            self.terms.extend(found)
            self.times.extend(found.values())
            self.owners.extend([len(self.doc_ids)] * len(found))
            self.doc_ids.append(NO_ID if doc_id is None else doc_id)
            self.lengths.append(n)

    def row(self) -> pa.RecordBatch:
        # Lists have their documents by ascending doc_id.
        order = np.argsort(np.array(self.doc_ids, np.int64), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        terms, owners = np.array(self.terms, np.int64), place[np.array(self.owners, np.int64)]
        by = np.lexsort((owners, terms))
        used, sizes = np.unique(terms, return_counts=True)
        values = (
            used.astype("<u4"), sizes.astype("<u4"), owners[by].astype("<u4"), np.array(self.times, np.int64)[by].astype("<i8"),
            np.array(self.doc_ids, np.int64)[order], np.array(self.lengths, np.int64)[order],
        )
        row = (self.docs, self.words, *(v.tobytes() for v in values))
        schema = arrow_schema(SHARDS)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _holders(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(queries.value.terms), np.int64)
        for batch in batches:
            for terms, sizes in zip(batch.column("terms").to_pylist(), batch.column("sizes").to_pylist()):
                counts[np.frombuffer(terms, "<u4")] += np.frombuffer(sizes, "<u4")
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], schema=arrow_schema(HELD))

    return run


class Index:
    """A shard's lists with what each entry adds to a score."""

    def __init__(self, row: dict, weights: np.ndarray, docs: int, words: int):
        self.terms, sizes, self.owners = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("terms", "sizes", "owners"))
        times, self.doc_ids, lengths = (np.frombuffer(row[c], "<i8") for c in ("times", "doc_ids", "lengths"))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        share = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * docs // words for n in lengths.tolist()], np.int64)
        saturated = 1_000_000_000 * times // (1000 * times + 12 * share[self.owners])
        self.adds = np.repeat(weights[self.terms], sizes) * saturated
        self.most = np.maximum.reduceat(self.adds, self.bounds[:-1]) if len(sizes) else np.zeros(0, np.int64)

    def lists(self, terms: np.ndarray, times: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Bound, documents and adds of the lists of some terms, the shortest first."""
        at = np.searchsorted(self.terms, terms)
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == terms[there]
        at, times = at[there], times[there]
        found = []
        for i in np.argsort(self.bounds[at + 1] - self.bounds[at], kind="stable"):
            own = slice(self.bounds[at[i]], self.bounds[at[i] + 1])
            if self.most[at[i]]:
                found.append((int(self.most[at[i]] * times[i]), self.owners[own], self.adds[own] * times[i] if times[i] > 1 else self.adds[own]))
        return found


def summed(docs: list[np.ndarray], adds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct documents, and the sums of what they get."""
    every, values = np.concatenate(docs), np.concatenate(adds)
    order = np.argsort(every, kind="stable")
    every = every[order]
    heads = np.flatnonzero(np.diff(every, prepend=-1))
    return every[heads], np.add.reduceat(values[order], heads) if len(heads) else np.zeros(0, np.int64)


class Best:
    """An item's best documents so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.doc_ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """A document of a lower score is not among the best; one of this score may be, by its doc_id."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, doc_ids: np.ndarray) -> None:
        scores, doc_ids = np.concatenate([self.scores, scores]), np.concatenate([self.doc_ids, doc_ids])
        order = np.lexsort((doc_ids, -scores))[: self.k]
        self.scores, self.doc_ids = scores[order], doc_ids[order]

    def full(self) -> bool:
        return len(self.scores) == self.k


def hybrid(index: Index, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
    """Add a shard's documents to an item's best."""
    lists = index.lists(terms, times)
    if not lists:
        return
    # Term at a time: the short lists become one list of sums.
    size, short = 0, 0
    while short < len(lists) and size + len(lists[short][1]) <= SHORT:
        size += len(lists[short][1])
        short += 1
    iterators = lists[short:]
    if short:
        docs, adds = summed([own for _, own, _ in lists[:short]], [a for *_, a in lists[:short]])
        iterators.append((int(adds.max()), docs, adds))
    # Document at a time, by ranges: the iterators of the lowest bounds are only probed.
    iterators.sort(key=lambda i: i[0])
    ceilings = np.cumsum([bound for bound, *_ in iterators])
    at, step, n = 0, RANGE, len(index.doc_ids)
    while at < n:
        end = n if best.full() else min(n, at + step)
        least = best.least()
        probed = int(np.searchsorted(ceilings, least))
        if probed == len(iterators):
            return
        docs, adds = [], []
        for _, own, values in iterators[probed:]:
            a, b = (0, len(own)) if at == 0 and end == n else np.searchsorted(own, (at, end))
            docs.append(own[a:b])
            adds.append(values[a:b])
        found, scores = summed(docs, adds)
        for i in range(probed - 1, -1, -1):
            able = scores + ceilings[i] >= least
            if not able.all():
                found, scores = found[able], scores[able]
            if not len(found):
                break
            _, own, values = iterators[i]
            place = np.minimum(np.searchsorted(own, found), len(own) - 1)
            scores = scores + np.where(own[place] == found, values[place], 0)
        able = scores >= least
        if able.any():
            best.add(scores[able], index.doc_ids[found[able]])
        at, step = end, 2 * step


def _searcher(queries, weights, docs: int, words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = queries.value, [Best(k) for _ in queries.value.items]
        for batch in batches:
            for row in batch.to_pylist():
                if row["terms"]:
                    index = Index(row, weights.value, docs, words)
                    for (terms, times), best in zip(own.wanted, found):
                        hybrid(index, terms, times, best)
        for item, best in zip(own.items, found):
            there = pa.array(best.doc_ids, mask=best.doc_ids == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(there), pa.string()), there, pa.array(best.scores)], schema=arrow_schema(FOUND))

    return run


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> str:
    return rf"unnest(regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"


STATEMENT = f"""
WITH rows AS (
    SELECT row_number() OVER () AS number, doc_id, text FROM documents WHERE text IS NOT NULL
), terms AS (
    SELECT number, doc_id, {_terms("text")} AS term FROM rows
), lengths AS MATERIALIZED (
    SELECT number, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY number
), totals AS MATERIALIZED (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths
), times AS MATERIALIZED (
    SELECT number, term, count(*) AS tf FROM terms GROUP BY number, term
), weights AS MATERIALIZED (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM times, totals GROUP BY term, docs
), wanted AS MATERIALIZED (
    SELECT item_id, term, count(*) AS often FROM (
        SELECT item_id, {_terms("text")} AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
    ) GROUP BY item_id, term
), scored AS (
    SELECT item_id, doc_id, number,
        CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // words)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN times USING (term) JOIN lengths USING (number), totals GROUP BY item_id, doc_id, number
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {BEST}
"""
