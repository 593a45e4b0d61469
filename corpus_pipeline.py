"""Documents to shards: quality rules, one of each group of near copies, no benchmark passages, a mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.llm import decontaminate, mixing, quality, sharding, similar
from facetide.llm.common import stored, table

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    good = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1").select("doc_id")
    return quality.quality(docs, good).where("kept").select(*DOCUMENTS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return similar.keep_one(docs).select(*DOCUMENTS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*DOCUMENTS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = mixing.mix(docs)
    return copies.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*DOCUMENTS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", no_benchmark),
    ("mixing_sources", mixed),
    ("sharding", sharded),
]

#: Hashes, trained scores and rounding are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
