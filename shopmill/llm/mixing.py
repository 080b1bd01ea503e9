"""Mix of sources to target weights, by a low-discrepancy schedule.

1. Sources in code point order (null last) weigh 5, 2, 1 and again; they share
   1.5 times all words. A target stops at twice its source's size and what is
   over is shared again by weight: the level at which all sources are either
   full or hold their weight's share is read off running sums.
2. A source's documents, shuffled by a hash, are one stream of words that is cut
   into blocks of equal size (the last one may be shorter). A source needs so
   many blocks that they hold its target; a second round takes blocks again.
3. Slot ``i`` of the mix is the point ``i`` times the golden ratio, modulo 1.
   Points are mapped through the cumulated numbers of blocks that the sources
   need, and a source's slots are ranked: rank ``r`` takes its block ``r``, round
   by round. Slots that a source got beyond its need go, in their order, to the
   sources that got too few.
4. Blocks are joined to the documents that lie in them by source and block, so
   each document knows the slots that take its words.

A source takes the whole words of its target, rounded down. All orders are
dealt by ranges (see ``ordered``), so a source with a third of all documents is
no single task's, and nothing but sums reaches the driver.

Words are separated by space and the characters 9 to 13; a null text has none.
A document without words is in no block and its ``taken`` is 0. A null source is
one source; a null doc_id is an id like others. Repeated rows are documents of
their own: equal rows differ only in which of them is taken twice. Empty tables
give empty results; a source without words has the target 0. Columns other than
``doc_id``, ``source`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import store
from shopmill.llm.ordered import running

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, again and again.
WEIGHTS = (5, 2, 1)
#: The mix holds so many times all words, and no source more than so many times its own.
SHARE, MOST = 1.5, 2
#: Words of a block.
BLOCK = 1024
#: Points are multiples of 2^-42; the odd number next to 2^42 over the golden ratio steps from one to the next.
POINTS, STEP, LIMB = 1 << 42, 2718142227965, 1 << 20
SEED = "mix-1"


@dataclass
class Mix:
    """What a mix takes.

    ``sources``: ``source, source_size, target, take`` and how they are cut;
    ``documents``: ``number`` (a row's place in the shuffled order), ``doc_id,
    source, size``; ``pieces``: ``slot, at`` (place in the slot), ``number,
    doc_id, begin, end`` (words of the document).
    """

    sources: DataFrame
    documents: DataFrame
    pieces: DataFrame


def mix(docs: DataFrame, block: int = BLOCK, share: float = SHARE, most: int = MOST, seed: str = SEED) -> Mix:
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select("doc_id", "source", size.alias("size"), shuffled.alias("turn"), F.xxhash64("text").alias("tie"))
    sized = store.settle(sized, "sizes")  # texts are read once; dealing by ranges reads its input twice
    order = [F.asc_nulls_last("source"), F.col("turn"), F.asc_nulls_last("doc_id"), F.col("size"), F.col("tie")]
    placed = store.settle(running(sized, order, start=F.col("size"), number=F.lit(1)).drop("turn", "tie"), "documents")
    sources = _sources(placed, block, share, most)
    slots = _slots(sources, block)
    known = sources.select(F.col("source").alias("own"), "position", F.col("start").alias("first"))
    within = placed.where("size > 0").join(known, F.col("source").eqNullSafe(F.col("own")))
    within = within.select("number", "doc_id", "size", "position", (F.col("start") - F.col("first")).alias("p"))
    blocks = F.sequence(F.expr(f"p div {block}"), F.expr(f"(p + size - 1) div {block}"))
    cut = within.withColumn("block", F.explode(blocks)).join(slots, ["position", "block"])
    pieces = cut.select(
        "slot", F.greatest(F.col("p"), F.col("begin")).alias("a"), F.least(F.col("p") + F.col("size"), F.col("end")).alias("b"),
        "begin", "number", "doc_id", "p",
    ).where("a < b")
    pieces = pieces.select(
        "slot", (F.col("a") - F.col("begin")).alias("at"), "number", "doc_id", (F.col("a") - F.col("p")).alias("begin"), (F.col("b") - F.col("p")).alias("end")
    )
    return Mix(sources, placed.select("number", "doc_id", "source", "size"), pieces)


def taken(found: Mix) -> DataFrame:
    """Per document its size, its source's size and target, and how many of its words the mix takes."""
    per = found.pieces.groupBy("number").agg(F.sum(F.col("end") - F.col("begin")).alias("taken"))
    known = found.sources.select(F.col("source").alias("own"), "source_size", "target")
    joined = found.documents.join(per.hint("merge"), "number", "left").join(known, F.col("source").eqNullSafe(F.col("own")))
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return taken(mix(spark.read.parquet(f"{folder}/documents.parquet")))


def _sources(placed: DataFrame, block: int, share: float, most: int) -> DataFrame:
    """Each source's size, weight, target and number of blocks; one row per source."""
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = running(sizes, [F.asc_nulls_last("source")], position=F.lit(1), start=F.col("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("position") % len(WEIGHTS) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * most)
    sizes = sizes.withColumn("ratio", F.col("most") / F.col("weight"))
    level = running(sizes, [F.col("ratio"), F.col("position")], full=F.col("most"), passed=F.col("weight"))
    level = store.settle(level, "levels")
    words, weights = level.agg(F.sum("source_size"), F.sum("weight")).first()
    level = level.withColumn("rest", F.lit((words or 0) * share) - F.col("full")).withColumn("left", F.lit(weights or 0) - F.col("passed"))
    # From the first source on that is not full, all hold their weight's share of the rest.
    open_ = F.min_by(F.struct("rest", "left"), F.struct("ratio", "position"))
    rest, left = level.where(F.col("ratio") * F.col("left") >= F.col("rest")).agg(open_).first()[0] or (0.0, 1)
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(float(rest)) / F.lit(float(left)))
    found = level.withColumn("target", target).withColumn("take", F.floor("target"))
    a_round, rest = F.expr(f"(source_size + {block - 1}) div {block}"), F.expr(f"(take % nullif(source_size, 0) + {block - 1}) div {block}")
    needed = F.coalesce(F.expr("take div nullif(source_size, 0)") * a_round + rest, F.lit(0))
    found = found.select(
        "source", "position", "start", "source_size", "weight", "target", "take", a_round.alias("blocks"), needed.alias("needed")
    )
    return store.settle(running(found, [F.col("position")], before=F.col("needed")), "sources")


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """``slot, position, block, begin, end``: which words of which source's stream a slot takes."""
    spark = sources.sparkSession
    n = sources.agg(F.sum("needed")).first()[0] or 0
    point = (F.col("slot") % LIMB * STEP + F.expr(f"slot div {LIMB}") * (STEP * LIMB % POINTS)) % POINTS
    points = spark.range(n).select(F.col("id").alias("slot")).select(point.alias("key"), "slot", F.lit(0).cast("long").alias("turn"))
    able = sources.where("needed > 0")
    starts = able.select(F.ceil(F.col("before") / max(n, 1) * POINTS).alias("key"), F.lit(-1).cast("long").alias("slot"), F.lit(1).cast("long").alias("turn"))
    # A point belongs to the source whose interval began last before it.
    swept = running(starts.unionByName(points), [F.col("key"), F.col("slot")], index=F.col("turn")).where("slot >= 0")
    ranked = store.settle(running(swept.select("slot", "index"), [F.col("index"), F.col("slot")], number=F.lit(1)), "ranked")
    got = ranked.groupBy("index").agg(F.count("*").alias("got"), F.min("number").alias("lowest"))
    numbered = running(able, [F.col("position")], index=F.lit(1)).withColumn("index", F.col("index") + 1)
    known = store.settle(numbered.join(got, "index", "left").fillna(0, ["got", "lowest"]), "needs")
    slots = ranked.join(known.select("index", "needed", "lowest"), "index")
    slots = slots.select("slot", "index", (F.col("number") - F.col("lowest")).alias("rank"), "needed")
    over = running(slots.where("rank >= needed").select("slot"), [F.col("slot")], k=F.lit(1))
    short = running(known.where("got < needed").select("index", "got", "needed"), [F.col("index")], base=F.col("needed") - F.col("got"))
    short = short.select("index", "base", "got", F.explode(F.sequence(F.col("got"), F.col("needed") - 1)).alias("rank"))
    moved = short.select("index", "rank", (F.col("base") + F.col("rank") - F.col("got")).alias("k")).join(over, "k")
    every = slots.where("rank < needed").select("slot", "index", "rank").unionByName(moved.select("slot", "index", "rank"))
    placed = every.join(known.select("index", "position", "source_size", "take", "blocks"), "index")
    placed = placed.withColumn("block", F.col("rank") % F.col("blocks")).withColumn("begin", F.col("block") * block)
    before = F.expr("rank div blocks") * F.col("source_size") + F.col("begin")
    end = F.least(F.col("begin") + block, F.col("source_size"), F.col("begin") + F.col("take") - before)
    return placed.select("slot", "position", "block", "begin", end.alias("end"))


STATEMENT = f"""
WITH sized AS (
    SELECT doc_id, source, md5(concat('{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''))) AS turn,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
    FROM documents
), own AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM sized GROUP BY source
), weighed AS (
    SELECT *, CAST([5, 2, 1][(n - 1) % 3 + 1] AS BIGINT) AS weight, source_size * {MOST} AS most FROM own
), sums AS (
    SELECT *, most / weight AS ratio,
        sum(most) OVER w - most AS filled, sum(weight) OVER () - sum(weight) OVER w + weight AS left_over,
        sum(source_size) OVER () * {SHARE}::DOUBLE AS words
    FROM weighed WINDOW w AS (ORDER BY most / weight, n)
), levels AS (
    SELECT *, words - CAST(filled AS DOUBLE) AS rest FROM sums
), level AS (
    SELECT rest, left_over FROM levels WHERE ratio * CAST(left_over AS DOUBLE) >= rest ORDER BY ratio, n LIMIT 1
), targets AS (
    SELECT s.source, s.source_size, least(CAST(most AS DOUBLE), CAST(weight AS DOUBLE) * l.rest / CAST(l.left_over AS DOUBLE)) AS target
    FROM levels s, level l
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY turn, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS p FROM sized
), mixed AS (
    SELECT d.doc_id, d.size, d.p, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS take
    FROM placed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(greatest(least(size, take - p), 0) + greatest(least(size, take - source_size - p), 0) AS BIGINT) AS taken
FROM mixed
"""
