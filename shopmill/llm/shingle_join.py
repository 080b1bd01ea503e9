"""Near-duplicate documents: Jaccard join of word 5-gram sets by T-occurrence search.

Two documents link when 75 percent or more of their distinct 5-grams are
common; the result has for each document the smallest doc_id that links reach.

1. All 5-gram hashes are dealt over buckets and counted, in how many documents
   each stands; a hash that several documents of a slice hold goes there once,
   with their number, and its documents stay with the slice. A hash of one
   document cannot be common. A set of ``n`` needs
   ``T = ceil(0.75 n)`` common elements to link at all; sets with fewer shared
   hashes are done. The others keep their shared hashes, rarest first.
2. Equal sets become one class (a hash of the set tells).
3. A class's first ``shared - T + 1`` hashes are its prefix: similar sets have
   a prefix element in common. All classes of an element come together under
   the smallest class of its list, so that a class goes to few groups.
4. Groups are cut into blocks of bounded size; each block is searched by
   T-occurrence. Blocks of one group have some classes in common, which mostly
   joins their components. Where a group still has several components, the
   classes outside its largest one are searched against all, in blocks, which
   makes the result exact.
5. Components of the links (contraction in Spark) give the answer.

No stage emits pairs: a block returns each class's component. Words are
separated by space and the characters 9 to 13, A to Z are lower-cased. A text
of fewer than five words has its whole sequence as its one element; a null or
empty text has none and links with nothing. Repeated rows are copies. A null
doc_id takes part, but is no component's name unless all its members have
none. Empty tables give empty results. Columns other than ``doc_id`` and
``text`` are not read. Elements and sets count as equal if their hashes (64 and 128 bits) are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopmill.llm import store
from shopmill.llm.arrow import arrow_schema
from shopmill.llm.graph import components
from shopmill.llm.occurrence import Search
from shopmill.llm.repeats import packed_steps, places_of, runs
from shopmill.llm.words import Texts, slices, windows

SHINGLE, PERCENT = 5, 75
#: Bytes of text of one slice, of packed hashes in one bucket on average, of one searched block.
SLICE, BUCKET, BLOCK = 2 << 20, 8 << 20, 1 << 20
#: Classes that all blocks of a group have in common, on average.
COMMON = 32
#: Numbers of documents from here on count as this when hashes are ordered.
MOST = (1 << 32) - 1

#: A bucket's hashes of a slice: those of one document with it, those of several (``many``) with their number
#: (``times``). Or, with sets, the slice's documents, and of which (``owners``) those of several are.
SENT = "slice long, bucket int, hashes binary, steps binary, many binary, times binary, owners binary, there binary, counts binary, doc_ids binary, keys binary, sets binary"
#: The same without buckets; ``counts`` and ``times`` are then numbers of documents of the whole corpus.
SHARED = SENT.replace("bucket int, ", "")
SETS = "doc_id long, key long, n_shingles long, set_a long, set_b long, prefix int, shared binary"
POSTINGS = "element long, class long"
STARS = "a long, b long"


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, root`` for each document.

    ``key`` is the hash of doc_id and text. ``root`` tells components apart
    even where all their doc_ids are null; it is null for an empty set.
    """
    sets = _sets(docs, shingle, percent)
    classes = _classes(sets)
    roots = components(_links(classes, percent))
    named = (
        classes.join(roots.withColumnRenamed("id", "class"), "class", "left")
        .select("set_a", "set_b", "least", F.coalesce("root", "class").alias("root"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("set_a", "set_b", "component_id", "root")
    # A class may hold a third of all documents; it is one row on the right.
    found = sets.drop("prefix", "shared").join(named, ["set_a", "set_b"], "left")
    some = F.col("n_shingles") > 0
    return found.select(
        "doc_id", "key", "n_shingles", F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.col("root")).alias("root"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each group of near duplicates (the smallest doc_id); empty ones all stay."""
    found = near_duplicates(docs, shingle, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    chosen = found.where("root IS NOT NULL").groupBy("root").agg(first.alias("first"))
    chosen = chosen.select("first.doc_id", "first.key", F.lit(False).alias("every"))
    empty = found.where("root IS NULL").select("doc_id", "key", F.lit(True).alias("every"))
    chosen = chosen.unionByName(empty).groupBy("doc_id", "key").agg(F.max("every").alias("every"))
    chosen = chosen.select(F.col("doc_id").alias("own"), F.col("key").alias("own_key"), "every")
    # The chosen rows grow with the corpus: never broadcast them. The hash of a text tells rows of one doc_id apart.
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", key.alias("key"))
    joined = rows.join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("key") == F.col("own_key")))
    number = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("key"))
    return joined.withColumn("number", number).where("number = 1 OR every").select("row.*")


def op8_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id")


def _sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per document its set's size and hash and, if it may link, its shared hashes, rarest first."""
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total * 3 // 2 // BUCKET
    sent = texts.mapInArrow(_sender(shingle, buckets), SENT)
    shared = store.deal(sent, buckets).mapInArrow(_sharer, SHARED)
    return store.settle(shared.groupBy("slice").applyInArrow(_ranker(percent), SETS), "sets", free=True)


def _classes(sets: DataFrame) -> DataFrame:
    """Documents with equal sets as one row, numbered."""
    own = sets.where("n_shingles > 0").groupBy("set_a", "set_b")
    classes = own.agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("prefix").alias("prefix"), F.first("shared").alias("shared"),
    )
    return store.settle(classes.withColumn("class", F.monotonically_increasing_id()), "classes")


def _links(classes: DataFrame, percent: int) -> DataFrame:
    """Edges whose components are those of all links between classes."""
    able = classes.where("shared IS NOT NULL")
    postings = able.select("class", "prefix", "shared").mapInArrow(_poster, POSTINGS)
    leads = postings.groupBy("element").agg(F.min("class").alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = store.settle(postings.join(leads, "element").select("lead", "class").distinct(), "members")
    sizes = members.join(able.select("class", F.octet_length("shared").alias("bytes")), "class")
    totals = sizes.groupBy("lead").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("members"))
    groups = store.settle(totals.select("lead", "members", (1 + F.expr(f"bytes div {BLOCK}")).alias("blocks")), "groups")

    placed = members.join(groups, "lead")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    common = F.pmod(F.xxhash64("class", F.lit(1)), F.col("members")) < COMMON
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    placed = placed.select("lead", "class", F.explode(F.when(common, every).otherwise(F.array(own))).alias("block"))
    held = able.select("class", "n_shingles", "shared")
    keyed = placed.join(held, "class").withColumn("root", F.col("class"))
    searcher = _searcher(percent)
    first = store.settle(keyed.groupBy("lead", "block").applyInArrow(searcher, STARS), "links")

    cut = groups.where("blocks > 1").select("lead")
    if cut.isEmpty():
        return first
    known = components(first)
    rooted = members.join(cut, "lead").join(known.withColumnRenamed("id", "class"), "class", "left")
    rooted = rooted.select("lead", "class", F.coalesce("root", "class").alias("root"))
    per_root = rooted.groupBy("lead", "root").agg(F.count("*").alias("n"))
    largest = per_root.groupBy("lead").agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("roots"))
    rooted = rooted.join(largest.where("roots > 1"), "lead").join(able.select("class", F.octet_length("shared").alias("bytes")), "class")
    rooted = store.settle(rooted.withColumn("outside", F.col("root") != F.col("largest")), "rooted")
    blocks = rooted.groupBy("lead").agg(
        (1 + F.expr(f"sum(if(outside, bytes, 0)) div {BLOCK}")).alias("sides"), (1 + F.expr(f"sum(bytes) div {BLOCK}")).alias("blocks")
    )
    rooted = rooted.join(blocks, "lead")
    side, block = F.pmod(F.xxhash64("class"), F.col("sides")), F.pmod(F.xxhash64("class", F.lit(2)), F.col("blocks"))
    sides, every = (F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("sides", "blocks"))
    asked = rooted.select("lead", "class", "root", F.explode(sides).alias("side"), block.alias("block"))
    index = rooted.where("outside").select("lead", "class", "root", side.alias("side"), F.explode(every).alias("block"))
    both = asked.unionByName(index).distinct().join(held, "class")
    second = store.settle(both.groupBy("lead", "side", "block").applyInArrow(searcher, STARS), "links")
    return first.unionByName(second)


def _sender(shingle: int, buckets: int):
    import xxhash

    schema = arrow_schema(SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE):
            texts = Texts(batch.column("text"), lower=True)
            counts = texts.counts()
            hashes = windows(texts.hashes, shingle)
            left = np.repeat(texts.first[1:], counts)[: len(hashes)] - np.arange(len(hashes))
            at = np.flatnonzero(left >= shingle)
            hashes, owners = hashes[at], np.searchsorted(texts.first, at, "right") - 1
            for k in range(1, shingle):
                few = np.flatnonzero(counts == k)
                if len(few):
                    hashes = np.concatenate([hashes, windows(texts.hashes, k)[texts.first[few]] ^ np.uint64(k)])
                    owners = np.concatenate([owners, few])
            order = np.lexsort((owners, hashes))
            hashes, owners = hashes[order], owners[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
            hashes, owners = hashes[new], owners[new]
            heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            sizes = np.diff(heads, append=len(hashes))
            several = np.repeat(sizes > 1, sizes)
            many, times = hashes[heads[sizes > 1]], sizes[sizes > 1].astype("<u4")
            shared_by = owners[several].astype("<u4")
            order = np.argsort(owners.astype(np.uint16) if len(texts) <= 1 << 16 else owners, kind="stable")
            hashes, owners, single = hashes[order], owners[order], ~several[order]
            bounds = np.searchsorted(owners, np.arange(len(texts) + 1))
            sets = b"".join(xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:]))
            hashes, owners = hashes[single], owners[single]
            bucket, many_bucket = ((h >> np.uint64(32)).astype(np.int64) * buckets >> 32 for h in (hashes, many))
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            hashes, owners = hashes[order], owners[order]
            alone, together = dict(runs(bucket[order])), dict(runs(many_bucket))
            none, rows = slice(0, 0), []
            for b in sorted(alone.keys() | together.keys()):
                own, others = alone.get(b, none), together.get(b, none)
                packed = (hashes[own].tobytes(), packed_steps(owners[own]), many[others].tobytes(), times[others].tobytes())
                rows.append((number, b, *packed, None, None, None, None, None, None))
            doc_ids = batch.column("doc_id")
            there = np.packbits(doc_ids.is_valid().to_numpy(zero_copy_only=False)).tobytes()
            ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            keys = batch.column("key").to_numpy().tobytes()
            own = (many.tobytes(), times.tobytes(), shared_by.tobytes(), there, np.diff(bounds).astype("<u4").tobytes(), ids, keys, sets)
            rows.append((number, number % buckets, None, None, *own))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            number += 1

    return run


def _sharer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that stand in several documents, and in how many, bucket by bucket back to their slices."""
    schema = arrow_schema(SHARED)
    held, bucket = [], None
    for batch in batches:
        for i, (number, place) in enumerate(zip(batch.column("slice").to_pylist(), batch.column("bucket").to_pylist())):
            if batch.column("sets")[i].is_valid:
                row = [batch.column(c)[i].as_py() for c in schema.names]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)
                continue
            if place != bucket:
                yield from _several(held, schema)
                held, bucket = [], place
            views = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("hashes", np.uint64), ("many", np.uint64), ("times", "<u4")))
            held.append((number, batch.column("steps")[i].as_py(), *views))
    yield from _several(held, schema)


def _several(held: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    hashes = np.concatenate([own for *_, single, many, _ in held for own in (single, many)])
    times = np.concatenate([own for *_, single, many, n in held for own in (np.ones(len(single), "<u4"), n)])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    totals = np.minimum(np.add.reduceat(times[order].astype(np.int64), heads), MOST)
    counts = np.empty(len(hashes), "<u4")
    counts[order] = np.repeat(totals, np.diff(heads, append=len(hashes)))
    del ordered, order
    at = 0
    for number, steps, single, many, _ in held:
        own, among = counts[at : at + len(single)], counts[at + len(single) : at + len(single) + len(many)]
        at += len(single) + len(many)
        several = own > 1
        if several.any() or len(many):
            places = packed_steps(places_of(steps)[several])
            row = (number, single[several].tobytes(), places, many.tobytes(), among.tobytes(), None, None, own[several].tobytes(), None, None, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _ranker(percent: int):
    schema = arrow_schema(SETS)

    def run(table: pa.Table) -> pa.Table:
        """A slice's documents; with their shared hashes, rarest first, if these are enough to link."""
        rows = table.to_pydict()
        at = next(i for i, sets in enumerate(rows["sets"]) if sets is not None)
        doc_ids, keys = (np.frombuffer(rows[c][at], "<i8") for c in ("doc_ids", "keys"))
        sizes = np.frombuffer(rows["counts"][at], "<u4").astype(np.int64)
        there = np.unpackbits(np.frombuffer(rows["there"][at], np.uint8))[: len(doc_ids)] == 0
        sets = np.frombuffer(rows["sets"][at], "<i8").reshape(-1, 2)
        # Hashes of several documents of the slice: their totals come from the buckets, in ascending order of hashes.
        many, times, shared_by = (np.frombuffer(rows[c][at], k) for c, k in (("many", np.uint64), ("times", "<u4"), ("owners", "<u4")))
        totals = np.zeros(len(many), "<u4")
        others = [i for i in range(table.num_rows) if i != at]
        for i in others:
            totals[np.searchsorted(many, np.frombuffer(rows["many"][i], np.uint64))] = np.frombuffer(rows["times"][i], "<u4")
        hashes = [np.repeat(many.view(np.int64), times), *(np.frombuffer(rows["hashes"][i], np.int64) for i in others)]
        owners = [shared_by.astype(np.int64), *(places_of(rows["steps"][i]) for i in others)]
        counts = [np.repeat(totals, times), *(np.frombuffer(rows["counts"][i], "<u4") for i in others)]
        hashes, owners, counts = (np.concatenate(c) for c in (hashes, owners, counts))
        order = np.lexsort((hashes, counts, owners))
        hashes, owners = hashes[order], owners[order]
        bounds = np.searchsorted(owners, np.arange(len(doc_ids) + 1))
        needed = -(-percent * sizes // 100)
        shared = np.diff(bounds)
        able = (shared >= needed) & (sizes > 0)
        kept = [hashes[bounds[i] : bounds[i + 1]].tobytes() if able[i] else None for i in range(len(doc_ids))]
        prefix = np.where(able, shared - needed + 1, 0)
        columns = [pa.array(doc_ids, mask=there), keys, sizes, sets[:, 0], sets[:, 1], prefix, kept]
        return pa.table([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema.types)], schema=schema)

    return run


def _poster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(POSTINGS)
    for batch in batches:
        for number, prefix, shared in zip(*(batch.column(c).to_pylist() for c in ("class", "prefix", "shared"))):
            elements = np.frombuffer(shared, np.int64)[:prefix]
            yield pa.RecordBatch.from_arrays([pa.array(elements), pa.array(np.full(prefix, number, np.int64))], schema=schema)


def _searcher(percent: int):
    schema = arrow_schema(STARS)

    def run(table: pa.Table) -> pa.Table:
        """Each class of a block, tied to the first one of its component."""
        numbers, sizes, roots = (table.column(c).to_numpy() for c in ("class", "n_shingles", "root"))
        sets = [np.frombuffer(s, np.int64) for s in table.column("shared").to_pylist()]
        group = Search(sizes, sets, roots, percent).run()
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        lead = numbers[first][inverse]
        tied = lead != numbers
        return pa.table([pa.array(lead[tied]), pa.array(numbers[tied])], schema=schema)

    return run
