"""Checkpoint registry and choice of the best model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Fixed starting values a model has to beat.
START_ACCURACY = 0.0
START_MAE = 100.0


def choose_best(results: DataFrame) -> DataFrame:
    """One row: highest gender accuracy and lowest age error, each with its model.

    Only a strictly better model replaces an earlier one, so the lowest ``idx`` wins ties. If none beats the
    starting value, the starting value is reported with the first model.
    """
    acc, mae, idx, path = (F.col(c) for c in ("mean_gender_acc", "mean_error_age", "idx", "path"))
    # Rows whose ordering value is null are no candidates. NaN compares as the largest, so it is ruled out by name.
    beats_acc = F.when((acc > START_ACCURACY) & ~F.isnan(acc), F.struct(acc, -idx))
    beats_mae = F.when(mae < START_MAE, F.struct(mae, idx))
    first = F.min_by(path, idx)
    return results.agg(
        F.coalesce(F.max_by(acc, beats_acc), F.lit(START_ACCURACY)).alias("best_gender_acc"),
        F.coalesce(F.max_by(path, beats_acc), first).alias("gender_model"),
        F.coalesce(F.min_by(mae, beats_mae), F.lit(START_MAE)).alias("best_age_mae"),
        F.coalesce(F.min_by(path, beats_mae), first).alias("age_model"),
    )


def retain_last(registry: DataFrame, n: int = 100, by: str = "run") -> DataFrame:
    """The newest ``n`` checkpoints of each run.

    Spark keeps only ``n`` rows per run and task before the shuffle (for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``), so one long run is no bottleneck.
    """
    newest = Window.partitionBy(by).orderBy(F.col("step").desc())
    return registry.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def latest(registry: DataFrame, by: str = "run") -> DataFrame:
    """The newest checkpoint of each run."""
    return registry.groupBy(by).agg(F.max("step").alias("step"), F.max_by("path", "step").alias("path"))
