"""Two-head losses and metrics: per row, per batch, per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from facetide.functions import abs_error, argmax, expected_index, in_top_k, l2_penalty, softmax, sparse_xent

# Fixed decay of the two output layers.
HEAD_DECAY = 1e-5


def score_rows(scored: DataFrame) -> DataFrame:
    """Replace the logits by what the metrics need: both losses, predictions, age error, gender hit."""
    return scored.select(
        *(c for c in scored.columns if c not in ("age_logits", "gender_logits")),
        sparse_xent("age_logits", "age_label").alias("age_xent"),
        sparse_xent("gender_logits", "gender_label").alias("gender_xent"),
        expected_index(softmax("age_logits")).alias("pred_age"),
        argmax("gender_logits").alias("pred_gender"),
        in_top_k("gender_logits", "gender_label", 1).alias("gender_hit"),
    ).withColumn("age_error", abs_error("pred_age", "age_label"))


def batch_metrics(scored: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Mean losses, age error and gender accuracy of each batch, from logits or from rows already measured."""
    rows = score_rows(scored) if "age_logits" in scored.columns else scored
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("age_xent").alias("age_xent"),
        F.avg("gender_xent").alias("gender_xent"),
        F.avg("age_error").alias("age_mae"),
        F.avg(F.col("gender_hit").cast("double")).alias("gender_acc"),
    )


def l2_total(weights: DataFrame, column: str = "weights", decay: float | Column = HEAD_DECAY) -> DataFrame:
    """One row: the sum of the L2 penalties of all weight tensors (one per row)."""
    return weights.agg(F.coalesce(F.sum(l2_penalty(column, decay)), F.lit(0.0)).alias("penalty"))


def with_total_loss(batches: DataFrame, penalty: float | Column | DataFrame = 0.0) -> DataFrame:
    """Add ``total_loss``: both mean losses plus the penalty (a number, a column, or a one-row frame)."""
    if isinstance(penalty, DataFrame):
        extra = penalty.scalar()
    else:
        extra = penalty if isinstance(penalty, Column) else F.lit(float(penalty))
    return batches.withColumn("total_loss", F.col("gender_xent") + F.col("age_xent") + extra)


def mean_of_means(batches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted means over batches: a short last batch counts as much as a full one."""
    aggs = [
        F.avg("age_mae").alias("mean_error_age"),
        F.avg("gender_acc").alias("mean_gender_acc"),
    ]
    if "total_loss" in batches.columns:
        aggs.append(F.avg("total_loss").alias("mean_loss"))
    return batches.groupBy(*by).agg(*aggs)


def evaluate_all(scored: DataFrame, by: Sequence[str] = ("idx",),
                 penalty: float | Column | DataFrame = 0.0) -> DataFrame:
    """One result row per model from all models' scored rows: two aggregates, each with partial sums."""
    batches = with_total_loss(batch_metrics(scored, [*by, "batch_id"]), penalty)
    return mean_of_means(batches, by)
