"""Queries over streams of records: scoring as files arrive, over restarts, and metrics added up over all micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.operators.metrics import score_rows
from facetide.plans.views import LOGITS, SCORED
from facetide.session import scratch_path
from facetide.sources import tfrecord
from facetide.streaming.running import read_running, running_metrics
from facetide.streaming.score import await_scored, read_scored, score_stream

SCHEMA = "vec_id long, age_label long, gender_label long, age_logits array<float>, gender_logits array<float>"
#: Vectors of one stretch, and the record files that stretches are dealt to in turn: files grow with the table, so the steps of
#: a stream do, and not their number. Each round begins one file earlier than the last, every 16th at a file by its hash, so ids
#: with wide gaps are dealt to all files too. Batches of 32 lie in two files where stretches meet.
FILE_ROWS, FILES = 150, 16

# All 64 elements: 62 age logits, two gender logits.
_WHOLE = """logits as (
  select 0 as idx, vec_id, vec_id // 32 as batch_id, label as age_label, label % 2 as gender_label,
    cast(list_slice(embedding, 1, 62) as double[]) as age_logits, cast(list_slice(embedding, 63, 64) as double[]) as gender_logits
  from embeddings)"""
_SCORED = SCORED.replace(LOGITS, _WHOLE)


def _arrive(spark: SparkSession, sf_dir: str, folder: str, lot: int) -> None:
    """Every other file of the vectors' records appears in the folder."""
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    stretch = F.floor(F.col("vec_id") / FILE_ROWS)
    turn = F.floor(stretch / FILES)
    begin = F.pmod(turn, F.lit(FILES)) + F.pmod(F.xxhash64(F.floor(turn / FILES)), F.lit(FILES))
    shard = F.pmod(stretch - begin, F.lit(FILES)).cast("int")
    rows = vectors.select(
        "vec_id", F.col("label").cast("long").alias("age_label"), (F.col("label") % 2).cast("long").alias("gender_label"),
        F.slice("embedding", 1, 62).alias("age_logits"), F.slice("embedding", 63, 2).alias("gender_logits"), shard.alias("shard"))
    placed = rows.where(F.col("shard") % 2 == lot).repartitionById(FILES, F.col("shard"))
    tfrecord.register(spark)
    placed.write.format("tfrecord").mode("append").option("split", "part").option("shardColumn", "shard").save(
        tfrecord.qualified(spark, folder))


def _drained(started) -> None:
    """Wait until all that has arrived is read."""
    try:
        started.processAllAvailable()
    finally:
        started.stop()


@query("stream_records", f"""
with {_SCORED}
select vec_id, age_label::bigint as age_label, gender_label::bigint as gender_label, round(pred_age, 6) as pred_age, pred_gender from scored
""")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records scored as they arrive, in steps of one file: the first run stops at its cap, then more files arrive, and a
    second run goes on where the first one stopped."""
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    stream = lambda: tfrecord.read_record_stream(spark, folder, f"{out}/arrivals", SCHEMA, max_files=1)
    _arrive(spark, sf_dir, folder, 0)
    await_scored(score_stream(stream(), lambda rows: rows, f"{out}/rows", f"{out}/state", max_batches=1, available_now=False),
                 available_now=False)
    _arrive(spark, sf_dir, folder, 1)
    _drained(score_stream(stream(), lambda rows: rows, f"{out}/rows", f"{out}/state", available_now=False))
    return read_scored(spark, f"{out}/rows").withColumn("pred_age", F.round("pred_age", 6))


@query("stream_running_metrics", f"""
with {_SCORED},
batches as (
  select batch_id, count(*) as n, avg(age_xent) as age_xent, avg(gender_xent) as gender_xent,
    avg(abs(pred_age - age_label)) as age_mae, avg(case when gender_hit then 1.0 else 0.0 end) as gender_acc
  from scored group by batch_id)
select cast(count(*) as bigint) as n_batches, cast(sum(n) as bigint) as n_rows, round(avg(age_mae), 6) as mean_error_age,
  round(avg(gender_acc), 6) as mean_gender_acc, round(avg(age_xent), 6) as mean_age_xent,
  round(avg(gender_xent), 6) as mean_gender_xent
from batches
""")
def stream_running_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 32 rows that lie in different files, which arrive in two lots and are read in steps over two runs: the
    means over batches at the end."""
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "running")
    for lot in (0, 1):
        _arrive(spark, sf_dir, folder, lot)
        stream = tfrecord.read_record_stream(spark, folder, f"{out}/arrivals", SCHEMA, max_files=2)
        measured = score_rows(stream).withColumn("position", F.col("vec_id"))
        _drained(running_metrics(measured, f"{out}/sums", f"{out}/state", available_now=False))
    found = read_running(spark, f"{out}/sums")
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.startswith("mean")})
