"""Metadata tables, prepared Parquet, prediction text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.functions import format_result

META_SCHEMA = (
    "file_name string, dob double, photo_taken int, gender double, face_score double, second_face_score double"
)


def read_meta(spark: SparkSession, path: str, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """Metadata rows with fixed columns, tagged with their corpus.

    Parquet keeps types of its own, such as 64-bit years, which are cast; a value that does not fit is null.
    """
    reader = spark.read.format(fmt).options(**options)
    rows = (reader if fmt in ("parquet", "orc") else reader.schema(META_SCHEMA)).load(path)
    fields = (f.split() for f in META_SCHEMA.split(", "))
    return rows.select(*(F.col(n).try_cast(t).alias(n) for n, t in fields), F.lit(source).alias("source"))


def write_prepared(df: DataFrame, path: str, n_shards: int, partitioned: bool = False) -> None:
    """Parquet with one folder per split and shard, so later reads open only what they ask for.

    Each row goes to the task of its shard first: one file per folder, not one per task and folder. Shards are even,
    so the tasks are. Pass ``partitioned=True`` if the rows are there already and carry image bytes.
    """
    if not partitioned:
        # Test shards come after the training shards.
        task = F.col("shard") + F.when(F.col("split") == "test", n_shards).otherwise(0)
        df = df.repartitionById(2 * n_shards, task)
    df.write.mode("overwrite").partitionBy("split", "shard").parquet(path)


def read_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def result_lines(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        format_result("ts", "real_gender", "real_age", "pred_gender", "pred_age").alias("value")
    )


def write_predictions_text(predictions: DataFrame, path: str) -> None:
    """One line of text per prediction."""
    result_lines(predictions).write.mode("overwrite").text(path)
