"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

Changes come in batches: inserts, deletes and revisions of documents with
their token counts. A commit looks up what the changed documents counted
before, writes the new states and the batch's delta (signed sums of documents
and tokens per source, language and tokenizer), and at last a mark. Totals
are sums of the deltas of marked batches. A batch id commits once: a repeated
commit does nothing, and one that died before its mark is written anew. Deltas are summed
before they are shuffled, so a source with a third of all documents is one row
per task.

A mark has the next number and is put in place only if no other batch took that
number; the loser looks the changed documents up again and tries the
next one. What an attempt wrote without getting its mark is never read, and
removed. The newest states of many batches are written together now and then, so
that a commit reads them and some batches.

A document is named by ``doc_id`` and ``part``, which tells documents apart that
share a doc_id or have none; without that column it is 0, or a hash of the row where
doc_id is null. ``copies`` says for how many equal documents a row stands (1
without that column). Of several changes of one document in a batch a
delete counts, else the largest row, and repeated rows are one. An insert of a
document that is there revises it, a revision of one that is not inserts it, and
a delete of one that is not does nothing. Changes of an
unknown kind take no part. A null source, language or tokenizer is a value of
its own; a null count is 0. Empty batches commit an empty delta; a store without
commits has no totals. Other columns are not read. Texts are counted one by one, whole,
however long.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from shopmill import session
from shopmill.llm import store, tokens

KEYS = ("source", "lang", "tokenizer")
NAME = ("doc_id", "part")
VALUES = (*KEYS, "tokens", "copies")
STATES = "doc_id long, part long, live boolean, source string, lang string, tokenizer string, tokens long, copies long, batch int"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"
MARKS = "batch_id string, batch int, folder string, base string"
#: Batches whose states are written together.
TOGETHER = 16

#: Native tokenizer versions: name and the words that count.
BLANK_WORDS = ("blank-words-1", r"[^\x20\x09-\x0D]+")
PLAIN_WORDS = ("plain-words-1", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def count_words(pattern: str, text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(pattern)), F.lit(0)).cast("long")


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Documents (doc_id, source, lang) with ``tokens``, their number of ids in a public vocabulary."""
    path = vocabulary or tokens.vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            counts = [len(encoder.encode(t.as_py())) // encoder.dtype.itemsize for t in batch.column("text")]
            columns = [batch.column(c) for c in ("doc_id", "source", "lang")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=["doc_id", "source", "lang", "tokens"])

    return docs.select("doc_id", "source", "lang", "text").mapInArrow(run, "doc_id long, source string, lang string, tokens long")


class Rollup:
    """A store of totals in one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def _marks(self) -> list[Row]:
        """Committed batches by number; one row each."""
        if not session.exists(self.spark, f"{self.path}/marks"):
            return []
        return self.spark.read.schema(MARKS).json(f"{self.path}/marks").orderBy("batch").collect()

    def _take(self, number: int, batch_id: str, folder: str, base: str) -> bool:
        """Put the mark of a number in place, unless it is there."""
        conf, gateway = self.spark.sparkContext._jsc.hadoopConfiguration(), self.spark.sparkContext._gateway
        written, mark = (self.hadoop.Path(f"{self.path}/{p}") for p in (f"{folder}/mark", f"marks/{number}"))
        system = mark.getFileSystem(conf)
        out = system.create(written, True)
        out.write(bytearray(json.dumps({"batch_id": batch_id, "batch": number, "folder": folder, "base": base}).encode()))
        out.close()
        system.mkdirs(mark.getParent())
        none = gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            self.hadoop.FileContext.getFileContext(system.getUri(), conf).rename(written, mark, none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            return False
        return True

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _states(self, marks: list[Row]) -> DataFrame:
        """States of committed batches; the last base holds the newest ones of all batches before it."""
        base = max((m.batch for m in marks if m.base), default=-1)
        folders = [f"{m.folder}/states" for m in marks if m.batch >= base]
        return self._read([*(m.base for m in marks if m.batch == base), *folders], STATES)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of changes (doc_id, change, source, lang, tokenizer, tokens); False if it was applied before."""
        if batch_id in {m.batch_id for m in self._marks()}:
            return False
        folder = f"batches/{uuid.uuid4().hex}"
        given = set(changes.columns)
        unnamed = F.when(F.col("doc_id").isNull(), F.xxhash64(*KEYS, "tokens")).otherwise(F.lit(0))
        part = F.coalesce("part", unnamed) if "part" in given else unnamed
        copies = F.coalesce("copies", F.lit(1)) if "copies" in given else F.lit(1)
        row = F.struct(
            (F.col("change") == "delete").alias("gone"), *KEYS, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), copies.cast("long").alias("copies")
        )
        wanted = changes.where("change IN ('insert', 'delete', 'revise')")
        wanted = wanted.groupBy(F.col("doc_id").cast("long").alias("doc_id"), part.cast("long").alias("part")).agg(F.max(row).alias("new"))
        # Texts are counted here, once.
        wanted.write.parquet(f"{self.path}/{folder}/wanted")
        wanted = self.spark.read.schema(wanted.schema).parquet(f"{self.path}/{folder}/wanted")
        while True:
            marks = self._marks()
            if batch_id in {m.batch_id for m in marks}:
                session.remove(self.spark, f"{self.path}/{folder}")
                return False
            number = marks[-1].batch + 1 if marks else 0
            self._write(wanted, marks, number, folder)
            # The base of a number holds the batches before it.
            base = f"{folder}/base" if number and number % TOGETHER == 0 else ""
            if base:
                self._newest(self._states(marks)).write.mode("overwrite").parquet(f"{self.path}/{base}")
            if self._take(number, batch_id, folder, base):
                session.remove(self.spark, f"{self.path}/{folder}/wanted")
                return True

    @staticmethod
    def _newest(states: DataFrame) -> DataFrame:
        newest = states.groupBy(*NAME).agg(F.max_by(F.struct("live", *VALUES), "batch").alias("old"), F.max("batch").alias("batch"))
        return newest.select(*NAME, "old.*", "batch")

    def _write(self, wanted: DataFrame, marks: list[Row], number: int, folder: str) -> None:
        """The batch's new states, and its delta against the states before it."""
        known = self._states(marks).select(*(F.col(c).alias(f"old_{c}") for c in (*NAME, "live", *VALUES, "batch")))
        same = F.col("doc_id").eqNullSafe(F.col("old_doc_id")) & (F.col("part") == F.col("old_part"))
        before = F.max_by(F.struct(*(F.col(f"old_{c}").alias(c) for c in ("live", *VALUES))), "old_batch")
        both = wanted.join(known, same, "left").groupBy(*NAME).agg(F.first("new").alias("new"), before.alias("old"))
        states = both.select(*NAME, (~F.col("new.gone")).alias("live"), *(f"new.{c}" for c in VALUES), F.lit(number).alias("batch"), "old")
        states.write.mode("overwrite").parquet(f"{self.path}/{folder}/states")
        written = self.spark.read.schema(states.schema).parquet(f"{self.path}/{folder}/states")
        minus = written.where("old.live").select(
            *(f"old.{c}" for c in KEYS), (-F.col("old.copies")).alias("docs"), (-F.col("old.copies") * F.col("old.tokens")).alias("tokens")
        )
        plus = written.where("live").select(*KEYS, F.col("copies").alias("docs"), (F.col("copies") * F.col("tokens")).alias("tokens"))
        delta = minus.unionByName(plus).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.path}/{folder}/deltas")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer, where there are documents."""
        deltas = self._read([f"{m.folder}/deltas" for m in self._marks()], DELTAS)
        summed = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 OR n_tokens <> 0")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents inserted, English ones counted anew by another version, one source deleted, two commits repeated.

    Rows that share a doc_id, or have none, are documents of their own: a hash of the
    row tells them apart, and equal rows are copies of one.
    """
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    own = docs.select("doc_id", F.xxhash64("source", "lang", "text").alias("part"), "source", "lang", "text")

    def counted(version: tuple[str, str], change: str, rows: DataFrame) -> DataFrame:
        name, pattern = version
        rows = rows.select(*NAME, "source", "lang", count_words(pattern).alias("tokens")).groupBy(*NAME, "source", "lang", "tokens")
        return rows.agg(F.count("*").alias("copies")).withColumns({"change": F.lit(change), "tokenizer": F.lit(name)})

    inserts = counted(BLANK_WORDS, "insert", own)
    revisions = counted(PLAIN_WORDS, "revise", own.where("lang = 'en'"))
    deletes = own.where("source = 'src1'").select(
        *NAME, "source", "lang", F.lit("delete").alias("change"), F.lit(None).cast("string").alias("tokenizer"), F.lit(0).alias("tokens")
    )
    rollup = Rollup(spark, store.new_path(spark, "token-counts"))
    for batch_id, changes in (("first", inserts), ("second", revisions), ("third", deletes), ("second", revisions), ("first", inserts)):
        rollup.commit(batch_id, changes)
    return rollup.totals()


STATEMENT = rf"""
WITH counted AS (
    SELECT source, lang, CASE WHEN lang = 'en' THEN '{PLAIN_WORDS[0]}' ELSE '{BLANK_WORDS[0]}' END AS tokenizer,
        coalesce(CASE WHEN lang = 'en' THEN len(regexp_extract_all(text, '{PLAIN_WORDS[1]}'))
            ELSE len(regexp_extract_all(text, '{BLANK_WORDS[1]}')) END, 0) AS tokens
    FROM documents WHERE source IS DISTINCT FROM 'src1'
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n_tokens FROM counted GROUP BY ALL
"""
