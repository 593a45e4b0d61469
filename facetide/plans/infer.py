"""Predict for labelled rows and write one line of text per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from facetide.operators.models import TwoHeadModel, predict
from facetide.sources.tables import write_predictions_text


def infer(df: DataFrame, model: TwoHeadModel, output: str, features: str = "features",
          num_partitions: int | None = None) -> None:
    """Score where the rows are; ``num_partitions`` spreads the small result rows over that many files."""
    predictions = predict(df.select("age", "gender", features), model, features)
    if num_partitions is not None:
        predictions = predictions.repartition(num_partitions)
    write_predictions_text(predictions.withColumn("ts", F.current_timestamp()), output)
