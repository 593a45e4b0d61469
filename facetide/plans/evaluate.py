"""Evaluate one model, or sweep all checkpoints of a run and pick the best."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from facetide.operators.metrics import batch_metrics, evaluate_all
from facetide.operators.models import TwoHeadModel, checkpoints, load_models, measure_rows
from facetide.operators.sampling import SPLIT_SEED, assign_batches, number_shuffled
from facetide.operators.selection import choose_best
from facetide.session import scratch_path

TEST_BATCH = 32


def _scored(test: DataFrame, models: list[tuple[str, TwoHeadModel]], key: str, features: str, batch_size: int,
            seed: int) -> DataFrame:
    """Measures of every model and row, in shuffled batches, the last one possibly short.

    Rows are scored where they are read and their measures stored; only those are put in order.
    """
    spark = test.sparkSession
    rows = test.select(F.col(key).alias("key"), F.col("age").alias("age_label"), F.col("gender").alias("gender_label"),
                       F.col(features).alias("features"))
    path = scratch_path(spark, "measures")
    measure_rows(rows, models).write.parquet(path)
    numbered = number_shuffled(spark.read.parquet(path), "key", seed, unique_key=False)
    batched = assign_batches(numbered, batch_size).select("batch_id", F.explode("measures").alias("m"))
    names = F.array(*(F.lit(p) for p, _ in models)), F.array(*(F.lit(m.penalty) for _, m in models))
    at = F.col("m.idx")
    return batched.select("batch_id", "m.*", F.get(names[0], at).alias("path"), F.get(names[1], at).alias("penalty"))


def evaluate_models(test: DataFrame, models: list[tuple[str, TwoHeadModel]], key: str = "key",
                    features: str = "features", batch_size: int = TEST_BATCH, seed: int = SPLIT_SEED) -> DataFrame:
    """One row per model: ``idx, path, mean_error_age, mean_gender_acc, mean_loss``; the data are read once."""
    scored = _scored(test, models, key, features, batch_size, seed)
    by = ["idx", "path", "penalty"]
    return evaluate_all(scored, by, F.col("penalty")).drop("penalty")


def evaluate_batches(test: DataFrame, model: TwoHeadModel, key: str = "key", features: str = "features",
                     batch_size: int = TEST_BATCH, seed: int = SPLIT_SEED) -> DataFrame:
    """The metrics of each batch of one model."""
    return batch_metrics(_scored(test, [("", model)], key, features, batch_size, seed), ["batch_id"])


def evaluate(test: DataFrame, model: TwoHeadModel, **options) -> DataFrame:
    """Age error, gender accuracy and loss of one model, averaged over batches."""
    return evaluate_models(test, [("", model)], **options).drop("idx", "path")


def choose_best_model(test: DataFrame, model_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """(best, results) over all checkpoints below ``model_dir``, oldest first."""
    paths = checkpoints(test.sparkSession, model_dir)
    if not paths:
        raise FileNotFoundError(f"no checkpoint below {model_dir}")
    models = list(zip(paths, load_models(test.sparkSession, paths)))
    results = evaluate_models(test, models, **options)
    return choose_best(results), results
