"""From labelled records to a trained model: features once, then training with checkpoints and a metric log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.functions import image_features
from facetide.functions.images import IMAGE_SHAPE
from facetide.operators.models import TwoHeadModel, save_model
from facetide.operators.training import train_sgd, train_two_head
from facetide.session import scratch_path
from facetide.sources.tfrecord import read_records


def features_table(records: DataFrame, featurize: Callable | None = None, path: str | None = None,
                   shape: Sequence[int] = IMAGE_SHAPE, batch_size: int = 64) -> DataFrame:
    """``key, features, age, gender`` of labelled records, computed once and written to ``path``.

    ``featurize`` makes a function from a batch of image tensors to a batch of feature vectors. Without it the records must have a ``features`` list. Training reads the features many times,
    so they are stored, which also fixes the row keys.
    """
    spark = records.sparkSession
    path = path or scratch_path(spark, "features")
    if featurize is not None:
        vectors = image_features("image_raw", featurize, shape, batch_size)
        records = records.select("age", "gender", vectors.alias("features"))
    (
        records.select("features", "age", "gender").withColumn("key", F.monotonically_increasing_id())
        .write.mode("overwrite").parquet(path)
    )
    return spark.read.parquet(path)


def load_features(spark: SparkSession, path: str, featurize: Callable | None = None, fmt: str = "tfrecord",
                  shape: Sequence[int] = IMAGE_SHAPE) -> DataFrame:
    """Features of a directory of records, TFRecord or Parquet; only the needed fields are read."""
    column = "features array<float>" if featurize is None else "image_raw binary"
    schema = f"age long, gender long, {column}"
    rows = read_records(spark, path, schema=schema) if fmt == "tfrecord" else spark.read.schema(schema).parquet(path)
    return features_table(rows, featurize, shape=shape)


def train(rows: DataFrame, model_dir: str, log_dir: str | None = None, run: str = "train", full_batch: bool = False,
          **options) -> TwoHeadModel:
    """Train on a features table and leave checkpoints in ``model_dir`` and the trace in ``log_dir``."""
    if full_batch:
        model = train_two_head(rows, **options)
        save_model(rows.sparkSession, model, model_dir)
        return model
    return train_sgd(rows, model_dir=model_dir, log_dir=log_dir, run=run, **options)[0]
