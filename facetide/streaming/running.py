"""Metrics of a stream, added up over all its micro-batches: batches stay open until all their rows have come.

A row's batch is given by its position (``position div batch_rows``), so it does not matter in which micro-batch, or in what
order, its rows arrive. The state of a key holds the sums of its open batches and, of the closed ones, the sum of their means.
Keys are the model and a stretch of ``STRETCH`` batches, so one model's rows are shared by many tasks and a key's state is
bounded. Every micro-batch appends what the keys it touched come to by then; the newest row of each key counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from facetide.session import ship

BATCH_ROWS = 32
#: Batches that share a key.
STRETCH = 1024
PARTS = "spark.sql.shuffle.partitions"
MEASURES = ("age_xent", "gender_xent", "age_error", "gender_hit")
_SUMS = ", ".join(f"{m} double" for m in MEASURES)


class OpenBatches(StatefulProcessor):
    """Closes a batch when its last row has come."""

    def __init__(self, keys: int, batch_rows: int):
        self.keys, self.batch_rows = keys, batch_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "batch long", f"n long, {_SUMS}")
        self.closed = handle.getValueState("closed", f"batches long, n long, {_SUMS}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        new: dict[int, list] = {}
        for frame in rows:
            sums = frame.groupby("batch")[list(MEASURES)].agg("sum")
            counts = frame.groupby("batch").size()
            for batch, n, values in zip(sums.index.tolist(), counts.tolist(), sums.to_numpy().tolist()):
                held = new.setdefault(batch, [0] + [0.0] * len(MEASURES))
                new[batch] = [a + b for a, b in zip(held, [n, *values])]
        done = list(self.closed.get() or (0, 0, *[0.0] * len(MEASURES)))
        for batch, values in new.items():
            if self.open.containsKey((batch,)):
                values = [a + b for a, b in zip(self.open.getValue((batch,)), values)]
            if values[0] > self.batch_rows:
                raise ValueError(f"batch {batch} of {key} has more than {self.batch_rows} rows: positions repeat")
            if values[0] == self.batch_rows:
                self.open.removeKey((batch,))
                done = [done[0] + 1, done[1] + values[0], *(a + b / values[0] for a, b in zip(done[2:], values[1:]))]
            else:
                self.open.updateValue((batch,), tuple(values))
        self.closed.update(tuple(done))
        # As of now: an open batch counts by the rows that it has.
        for values in self.open.values():
            done = [done[0] + 1, done[1] + values[0], *(a + b / values[0] for a, b in zip(done[2:], list(values)[1:]))]
        yield pd.DataFrame([[*key, *done]], columns=[*(f"k{i}" for i in range(self.keys)), "n_batches", "n_rows", *MEASURES])

    def close(self) -> None:
        pass


def running_metrics(measured: DataFrame, out: str, state: str, by: Sequence[str] = (), position: str = "position",
                    batch_rows: int = BATCH_ROWS, available_now: bool = True) -> StreamingQuery:
    """Start adding up a stream of rows with ``MEASURES`` (see ``score_rows``) and their ``position``, a number from 0 that is
    unique in each model (the columns ``by``). Sums go to ``out``; ``read_running`` turns them into metrics.

    Sets the session's state store to RocksDB, which this kind of state needs. The state has as many parts as tasks run at once,
    as each part costs a task, a worker and a commit in every micro-batch, however few rows come; a stream that goes on keeps
    the number it began with.
    """
    spark = measured.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    batch = F.floor(F.col(position) / batch_rows).cast("long")
    keys = [*by, "stretch"]
    rows = measured.select(*by, batch.alias("batch"), F.floor(batch / STRETCH).cast("long").alias("stretch"),
                           *(F.col(m).cast("double").alias(m) for m in MEASURES))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"k{i} {kinds[k]}" for i, k in enumerate(keys)) + f", n_batches long, n_rows long, {_SUMS}"
    sums = rows.groupBy(*keys).transformWithStateInPandas(OpenBatches(len(keys), batch_rows), schema, "Update", "None")
    named = sums.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), "n_batches", "n_rows", *MEASURES)

    def write(part: DataFrame, number: int) -> None:
        part.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = named.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state)
    # A stream takes the setting as it is when it starts.
    setting, parts = spark.conf.get(PARTS), spark.sparkContext.defaultParallelism
    spark.conf.set(PARTS, min(int(setting), parts))
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(PARTS, setting)


def read_running(spark: SparkSession, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Of each model, so far: ``n_batches``, ``n_rows`` and the means over batches, ``mean_error_age``, ``mean_gender_acc``,
    ``mean_age_xent`` and ``mean_gender_xent``."""
    sums = ("n_batches", "n_rows", *MEASURES)
    newest = spark.read.parquet(out).groupBy(*by, "stretch").agg(F.max_by(F.struct(*sums), "batch").alias("s"))
    total = newest.groupBy(*by).agg(*(F.sum(f"s.{c}").alias(c) for c in sums))
    mean = lambda m: F.col(m) / F.col("n_batches")
    return total.select(*by, "n_batches", "n_rows", mean("age_error").alias("mean_error_age"),
                        mean("gender_hit").alias("mean_gender_acc"), mean("age_xent").alias("mean_age_xent"),
                        mean("gender_xent").alias("mean_gender_xent"))
