"""Views that derive this package's inputs (metadata, detections, logits, records) from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_name(doc_id) -> F.Column:
    return F.concat(F.lit("src/"), doc_id.cast("string"), F.lit(".jpg"))


def face_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata with NaN and infinite scores, clamped birth dates and out-of-range ages."""
    doc = F.col("doc_id")
    nan, low = F.lit(float("nan")), F.lit(float("-inf"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        file_name(doc).alias("file_name"),
        F.when(doc % 17 == 0, F.lit(0.0))
        .otherwise((711000 + (doc * 37) % 25000).cast("double") + 0.5)
        .alias("dob"),
        (1960 + (doc * 13) % 60).cast("int").alias("photo_taken"),
        F.coalesce(F.col("quality").cast("double"), nan).alias("gender"),
        F.when(doc % 11 == 0, low).otherwise(((doc * 7919) % 1000).cast("double") / 200).alias("face_score"),
        F.when(doc % 3 == 0, ((doc * 31) % 1000).cast("double") / 200).otherwise(nan).alias("second_face_score"),
        "source",
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero to three detected faces per document."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    n_faces = (F.col("doc_id") % 4).cast("int")
    return documents.filter(n_faces > 0).select(
        "doc_id", F.explode(F.sequence(F.lit(0), n_faces - 1)).alias("det_idx")
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing in which one image of ten is missing."""
    return (
        table(spark, sf_dir, "documents")
        .filter(F.col("doc_id") % 10 != 0)
        .select(file_name(F.col("doc_id")).alias("path"), F.col("n_chars").alias("length"))
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-head outputs of five models over the embeddings, in batches of 32."""
    emb, idx = F.col("embedding"), F.col("idx")
    return (
        table(spark, sf_dir, "embeddings")
        .withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(4))))
        .select(
            "idx",
            "vec_id",
            F.expr("vec_id div 32").alias("batch_id"),
            F.col("label").alias("age_label"),
            (F.col("label") % 2).alias("gender_label"),
            F.slice(emb, 1 + 10 * idx, 10).alias("age_logits"),
            F.slice(emb, 51 + 2 * idx, 2).alias("gender_logits"),
        )
    )


def example(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with 2 x 2 x 3 byte images made from the documents' texts."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        (doc % 101).alias("age"),
        (doc % 2).alias("gender"),
        F.encode(F.substring(F.md5("text"), 1, 12), "UTF-8").alias("image_raw"),
        file_name(doc).alias("file_name"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints: one run per customer, one step per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run"),
        F.col("o_orderkey").alias("step"),
        F.concat(F.lit("ckpt-"), F.col("o_orderkey").cast("string")).alias("path"),
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training log: one row per step."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), "ts", "value")
