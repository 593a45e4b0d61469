"""Training traces: every n-th step, time between logged steps, the long metric log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Fixed intervals of the training loop.
LOG_EVERY = 100
SAVE_EVERY = 1000


def every_n(df: DataFrame, step: str = "step", n: int = LOG_EVERY) -> DataFrame:
    return df.filter(F.col(step) % n == 0)


def step_durations(steps: DataFrame, by: Sequence[str] = (), every: int = LOG_EVERY,
                   block: int = 1_000_000) -> DataFrame:
    """Seconds since the previous logged row, logging every ``every`` steps; null for a run's first row.

    A window over a whole run would sort it in one task. Steps are cut into blocks instead: each block finds its
    previous rows by itself, and only its first row needs the last time of an earlier block, which comes from
    a table with one row per block.
    """
    logged = every_n(steps, "step", every).withColumn("_block", F.expr(f"step div {int(block)}"))
    in_block = Window.partitionBy(*by, "_block").orderBy("step")
    run = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block")
    ends = (
        logged.groupBy(*by, "_block")
        .agg(F.max_by("ts", "step").alias("_end"))
        .withColumn("_carried", F.lag("_end").over(run))
        .drop("_end")
    )
    seconds = (F.unix_micros(F.col("ts").cast("timestamp"))
               - F.unix_micros(F.coalesce("_previous", "_carried").cast("timestamp"))) / F.lit(1e6)
    # Null-safe: a run without a name is a run.
    names = [*by, "_block"]
    ends = ends.select(*(F.col(n).alias(f"_of_{i}") for i, n in enumerate(names)), "_carried")
    same = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"_of_{i}")) for i, n in enumerate(names)))
    return (
        logged.withColumn("_previous", F.lag("ts").over(in_block))
        .join(ends, same)
        .withColumn("seconds", seconds)
        .drop("_block", "_previous", "_carried", *(f"_of_{i}" for i in range(len(names))))
    )


def metric_rows(metrics: DataFrame, run: str | Column, names: Sequence[str], step: str = "step") -> DataFrame:
    """Long form ``(run, step, name, value)`` of one column per metric."""
    label = F.lit(run) if isinstance(run, str) else run
    wide = metrics.select(
        label.alias("run"), F.col(step).cast("long").alias("step"), *(F.col(n).cast("double") for n in names)
    )
    return wide.unpivot(["run", "step"], list(names), "name", "value")


def log_metrics(rows: DataFrame, path: str) -> None:
    """Append metric rows to a log, one folder per run."""
    rows.write.mode("append").partitionBy("run").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("run string, step long, name string, value double")
        .parquet(path)
    )


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """A training log with the time of each step: a row per run and step. A step that was run again after a stop counts by
    its last time."""
    rows = spark.read.schema("run string, step long, name string, value double, ts timestamp").parquet(path)
    return rows.groupBy("run", "step").agg(F.max("ts").alias("ts"))
