"""Score rows as they arrive: predictions and metrics per micro-batch, each written exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from facetide.operators.metrics import batch_metrics, score_rows


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Files as they appear in ``path``; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


CAP = "the cap on micro-batches is reached"


def score_stream(rows: DataFrame, logits: Callable[[DataFrame], DataFrame], out: str, state: str,
                 metrics: str | None = None, max_batches: int | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start scoring a stream of labelled rows.

    ``logits`` turns rows into the columns ``age_label, gender_label, age_logits, gender_logits`` and whatever else to
    keep. Predictions go to ``<out>/batch=<n>``, batch metrics to ``<metrics>/batch=<n>``. A micro-batch that is run
    again after a failure replaces its own folder. The query ends when the files are used up, or when this
    run has scored ``max_batches`` micro-batches: the next one fails on purpose before anything of it is committed, and a
    later run goes on with it. Wait with ``await_scored``.
    """
    done: set[int] = set()

    def write(batch: DataFrame, number: int) -> None:
        if max_batches is not None and number not in done and len(done) >= max_batches:
            raise RuntimeError(CAP)
        done.add(number)
        scored = logits(batch)
        if metrics is not None:
            # Two outputs come from these rows.
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        predictions = score_rows(scored).drop("age_xent", "gender_xent", "gender_hit", "age_error")
        predictions.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if metrics is not None:
            per_batch = batch_metrics(scored.withColumn("micro_batch", F.lit(number)), ["micro_batch"])
            per_batch.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch={number}")
            scored.unpersist()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", state)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def await_scored(query: StreamingQuery, available_now: bool = True) -> None:
    """Wait until the files are used up or the cap is reached. A query that goes on (``available_now=False``) waits for more files
    when fewer came than the cap allows: it is stopped as soon as what has arrived is read."""
    try:
        if available_now:
            query.awaitTermination()
        else:
            query.processAllAvailable()
    except StreamingQueryException as error:
        if CAP not in str(error):
            raise
    finally:
        if not available_now:
            query.stop()


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    """All predictions written so far."""
    return spark.read.parquet(out).drop("batch")
