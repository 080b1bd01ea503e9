"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before kept; its result is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.
Null and empty texts pass the stages as each operator defines; an empty table
gives an empty result, and other columns than those of ``documents`` are
left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm import decontaminate, packing, quality, repeats, shingle_join, store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@store.prepared
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, carry=COLUMNS[1:]).where("predicted = 1").select(COLUMNS)


@store.prepared
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return shingle_join.keep_one(docs.select(COLUMNS))


@store.prepared
def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that stand in an earlier one; ``n_chars`` follows the text."""
    found = repeats.remove_repeats(docs, carry=COLUMNS[2:])
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(COLUMNS)


@store.prepared
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find(docs, benchmark, carry=COLUMNS[2:]).where(F.size("begins") == 0).select(COLUMNS)


@store.prepared
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, with the documents that each holds."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", repeat_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokenization, the classifier and the packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = store.settle(docs, f"stage-{number}")
    return docs
