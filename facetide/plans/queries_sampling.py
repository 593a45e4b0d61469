"""Queries over order: splits, numbering, shards, epochs, batches, schedules, registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.functions import decayed_lr, shard_name
from facetide.operators import sampling, selection, trace


def _split_sql(n_test: str) -> str:
    return f"""
with ranked as (
  select doc_id, row_number() over (order by md5(concat('2017|', cast(doc_id as varchar))), doc_id) as r,
    count(*) over () as n
  from documents)
select doc_id, case when r <= {n_test} then 'test' else 'train' end as split from ranked
"""


def _both(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    train, test = parts
    return train.select("doc_id", F.lit("train").alias("split")).unionByName(
        test.select("doc_id", F.lit("test").alias("split"))
    )


@query("split_exact_test", _split_sql("ceil(n * 0.01)"))
def split_exact_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id")
    return _both(sampling.split_exact(docs, "doc_id", test_size=0.01))


@query("split_exact_train", _split_sql("n - floor(n * 0.25)"))
def split_exact_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id")
    return _both(sampling.split_exact(docs, "doc_id", train_size=0.25))


@query("number_rows", """
select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as pos, count(*) over () as total
from orders
""")
def number_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return sampling.number_rows(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "pos", "total")


@query("number_shuffled", """
select o_orderkey, row_number() over (order by md5(concat('7|', cast(o_orderkey as varchar))), o_orderkey) - 1 as pos
from orders
""")
def number_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.number_shuffled(orders, "o_orderkey", seed=7).select("o_orderkey", "pos")


@query("assign_shards", """
with ranked as (
  select o_orderkey, row_number() over (order by md5(concat('2017|', cast(o_orderkey as varchar))), o_orderkey) - 1 as r,
    count(*) over () as n
  from orders),
bounds as (select p, n * p // 7 as lo, n * (p + 1) // 7 as hi
           from range(7) t(p), (select count(*) as n from orders))
select o_orderkey, cast(p as int) as shard, printf('train-%03d.tfrecords', p) as file,
  cast((r * 2 + 2 - 1) // n as int) as test_shard
from ranked join bounds on r >= lo and r < hi
""")
def assign_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey")
    numbered = sampling.number_shuffled(orders, "o_orderkey")
    test = sampling.assign_shards(numbered, sampling.n_test_shards(7)).withColumnRenamed("shard", "test_shard")
    return sampling.assign_shards(test, 7).select(
        "o_orderkey", "shard", shard_name("train", "shard").alias("file"), "test_shard"
    )


_STREAM = """
with stream as (
  select vec_id, epoch, row_number() over (
      order by epoch, md5(concat('2017|', cast(epoch as varchar), '|', cast(vec_id as varchar))), vec_id) - 1 as pos,
    count(*) over () as n
  from embeddings, range(3) t(epoch))
"""


@query("shuffle_epochs", _STREAM + "select vec_id, cast(epoch as int) as epoch, pos, n as total from stream")
def shuffle_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id")
    return sampling.shuffle_epochs(vectors, "vec_id", 3)


@query("epoch_batches", _STREAM + """
select vec_id, cast(epoch as int) as epoch, pos // 128 as batch_id from stream where pos < n // 128 * 128
""")
def epoch_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training batches: they run across epoch borders, and a short last one is dropped."""
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id")
    batched = sampling.assign_batches(sampling.shuffle_epochs(vectors, "vec_id", 3), 128, drop_last=True)
    return batched.select("vec_id", "epoch", "batch_id")


@query("eval_batches", """
select vec_id, (row_number() over (order by md5(concat('2017|', cast(vec_id as varchar))), vec_id) - 1) // 32 as batch_id
from embeddings
""")
def eval_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation batches: the short last one stays."""
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id")
    return sampling.assign_batches(sampling.number_shuffled(vectors, "vec_id"), 32).select("vec_id", "batch_id")


@query("cap_steps", _STREAM + """
select vec_id, cast(epoch as int) as epoch, pos // 64 as batch_id from stream where pos // 64 < 10
""")
def cap_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id")
    return sampling.training_batches(vectors, "vec_id", 3, 64, steps=10).select("vec_id", "epoch", "batch_id")


@query("lr_schedule", "select event_id as step, round(0.001 * pow(0.9, event_id // 3000), 9) as lr from events")
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.steps(spark, sf_dir).select("step", F.round(decayed_lr("step", 1e-3), 9).alias("lr"))


@query("every_n_steps", """
select event_id as step, value, event_id % 1000 = 0 as saved from events where event_id % 100 = 0
""")
def every_n_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = trace.every_n(fixtures.steps(spark, sf_dir), n=trace.LOG_EVERY)
    return logged.select("step", "value", (F.col("step") % trace.SAVE_EVERY == 0).alias("saved"))


@query("step_durations", """
select event_id as step,
  round((epoch_us(ts) - epoch_us(lag(ts) over (order by event_id))) / 1e6, 6) as seconds
from events where event_id % 100 = 0
""")
def step_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    durations = trace.step_durations(fixtures.steps(spark, sf_dir), block=2000)
    return durations.select("step", F.round("seconds", 6).alias("seconds"))


@query("retain_last", """
select run, step, path from (
  select o_custkey as run, o_orderkey as step, concat('ckpt-', cast(o_orderkey as varchar)) as path,
    row_number() over (partition by o_custkey order by o_orderkey desc) as r
  from orders) where r <= 3
""")
def retain_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.retain_last(fixtures.registry(spark, sf_dir), 3)


@query("latest_checkpoint", """
select o_custkey as run, max(o_orderkey) as step, concat('ckpt-', cast(max(o_orderkey) as varchar)) as path
from orders group by o_custkey
""")
def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.latest(fixtures.registry(spark, sf_dir))
