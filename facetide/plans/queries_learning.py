"""Queries over models: training, prediction, evaluation, the checkpoint sweep, streaming scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.operators import models, training
from facetide.plans.evaluate import choose_best_model, evaluate, evaluate_batches
from facetide.plans.views import SCORED
from facetide.session import scratch_path
from facetide.streaming.score import await_scored, read_scored, read_stream, score_stream


BATCH = 64


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"),
        F.col("embedding").alias("features"),
        F.col("label").alias("age"),
        (F.col("label") % 2).alias("gender"),
    )


@query("train_eval", """
select cast(101 as bigint) as age_classes, cast(2 as bigint) as gender_classes, count(*) as n_rows, true as flat, true as better
from embeddings
""")
def train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-batch training, saved, loaded and measured on all rows.

    Facts of the fit: its classes, that the mean loss hardly changes along its gradient any more (``flat``), and that it
    is below that of the best constant model, which is the entropy of the labels (``better``).
    """
    import math

    rows = _labelled(spark, sf_dir)
    path = models.save_model(spark, training.train_two_head(rows), scratch_path(spark, "model"))
    model = models.load_model(spark, path)
    shape = {"age_classes": len(model.age), "gender_classes": len(model.gender)}
    slope = training.gradient_norm(rows, model)
    counts = [[r["count"] for r in rows.groupBy(c).count().collect()] for c in ("age", "gender")]
    constant = sum(n / sum(c) * math.log(sum(c) / n) for c in counts for n in c)
    loss = evaluate_batches(rows, model).agg(
        F.sum("n_rows").alias("n"), (F.sum((F.col("age_xent") + F.col("gender_xent")) * F.col("n_rows")) / F.sum("n_rows")).alias("loss"))
    return loss.select(
        *(F.lit(n).cast("long").alias(c) for c, n in shape.items()), F.col("n").alias("n_rows"), F.lit(slope < 1e-2).alias("flat"),
        (F.col("loss") < constant).alias("better"))


# Weights of the two heads are mean vectors per label and per parity of the label; no bias.
_CENTROIDS = """
with v as (select vec_id, label, label % 2 as parity, unnest(range(64)) as i, cast(unnest(embedding) as double) as x
           from embeddings),
wa as (select label as k, i, avg(x) as w from v group by 1, 2),
wg as (select parity as k, i, avg(x) as w from v group by 1, 2),
za as (select vec_id, label, k, sum(x * w) as z from v join wa using (i) group by 1, 2, 3),
zg as (select vec_id, parity, k, sum(x * w) as z from v join wg using (i) group by 1, 2, 3),
ea as (select *, exp(z - max(z) over (partition by vec_id)) as e from za),
eg as (select *, exp(z - max(z) over (partition by vec_id)) as e from zg),
pa as (select vec_id, any_value(label) as label, sum(e * k) / sum(e) as pred_age,
         ln(sum(e)) - ln(sum(case when k = label then e end)) as age_xent from ea group by 1),
pg as (select vec_id, any_value(parity) as parity, cast(arg_max(k, z) as int) as pred_gender,
         ln(sum(e)) - ln(sum(case when k = parity then e end)) as gender_xent from eg group by 1),
p as (select * from pa join pg using (vec_id)),
penalty as (select 1e-5 / 2 * ((select sum(w * w) from wa) + (select sum(w * w) from wg)) as penalty)
"""


def _centroid_model(rows: DataFrame) -> models.TwoHeadModel:
    """A model from one mean vector per class: what reaches the driver is the size of the heads."""
    import numpy as np

    heads = []
    for label in ("age", "gender"):
        means = [F.avg(F.col("features")[i].cast("double")).alias(f"x{i}") for i in range(64)]
        found = sorted(rows.groupBy(label).agg(*means).collect())
        heads.append(np.column_stack([np.array([r[1:] for r in found]), np.zeros(len(found))]))
    return models.TwoHeadModel(*heads)


@query("train_sgd", f"""
select name, cast(floor(count / {BATCH}) as bigint) as steps, true as better
from (select count(*) as count from embeddings), (values ('total loss'), ('age_cross_entropy')) t(name)
""")
def train_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch in full batches: steps in the trace per loss, and whether the last one is below the first."""
    rows = _labelled(spark, sf_dir)
    _, trace = training.train_sgd(rows, epochs=1, batch_size=BATCH, steps=None, lr=0.05)
    return trace.where("name in ('total loss', 'age_cross_entropy')").groupBy("name").agg(
        F.count(F.lit(1)).alias("steps"), (F.max_by("value", "step") < F.min_by("value", "step")).alias("better"))


@query("predict", _CENTROIDS + """
select vec_id as key, case when vec_id % 7 <> 0 then parity end as real_gender, case when vec_id % 5 <> 0 then label end as real_age,
  pred_gender, round(pred_age, 6) as pred_age from p
""")
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model on rows of which some have no label."""
    rows = _labelled(spark, sf_dir)
    path = models.save_model(spark, _centroid_model(rows), scratch_path(spark, "model"))
    unlabelled = rows.withColumns({
        "gender": F.when(F.col("key") % 7 != 0, F.col("gender")), "age": F.when(F.col("key") % 5 != 0, F.col("age"))})
    return models.predict(unlabelled, models.load_model(spark, path)).withColumn("pred_age", F.round("pred_age", 6))


_SWEEP = _CENTROIDS.replace("""
penalty as (""", """
scales(step, f) as (values (1, 0.5::double), (2, 1.0::double), (3, 2.0::double)),
sa as (select vec_id, label, k, step, z * f as z from za, scales),
xa as (select *, exp(z - max(z) over (partition by vec_id, step)) as e from sa),
qa as (select vec_id, step, any_value(label) as label, sum(e * k) / sum(e) as pred_age from xa group by 1, 2),
penalty as (""")


@query("choose_best_model", _SWEEP + """,
b as (select *, (row_number() over (partition by step order by md5(concat('2017|', cast(vec_id as varchar))), vec_id) - 1) // 32 as batch_id
      from qa join (select vec_id, pred_gender, parity from pg) using (vec_id)),
m as (select step, batch_id, avg(abs(pred_age - label)) as mae, avg(case when pred_gender = parity then 1.0 else 0.0 end) as acc
      from b group by 1, 2),
r as (select step, avg(mae) as mae, avg(acc) as acc from m group by 1)
select round((select max(acc) from r), 6) as best_gender_acc, (select step from r order by acc desc, step limit 1) as gender_step,
  round((select min(mae) from r), 6) as best_age_mae, (select step from r order by mae, step limit 1) as age_step
""")
def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of one run (a closed-form model at three scales), all scored in one pass, and the best per metric."""
    rows = _labelled(spark, sf_dir)
    folder, model = scratch_path(spark, "model"), _centroid_model(rows)
    for step, scale in ((1, 0.5), (2, 1.0), (3, 2.0)):
        models.save_model(spark, models.TwoHeadModel(model.age * scale, model.gender * scale, step), folder)
    best, _ = choose_best_model(rows, folder)
    step = lambda c: F.regexp_extract(c, r"step=(\d+)", 1).cast("int")
    return best.select(
        F.round("best_gender_acc", 6).alias("best_gender_acc"), step("gender_model").alias("gender_step"),
        F.round("best_age_mae", 6).alias("best_age_mae"), step("age_model").alias("age_step"))


@query("predict_model", _CENTROIDS + """
select vec_id as key, parity as real_gender, label as real_age, pred_gender, round(pred_age, 6) as pred_age from p
""")
def predict_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    return models.predict(rows, _centroid_model(rows)).withColumn("pred_age", F.round("pred_age", 6))


@query("evaluate_model", _CENTROIDS + """,
b as (select *, (row_number() over (order by md5(concat('2017|', cast(vec_id as varchar))), vec_id) - 1) // 32 as batch_id
      from p),
m as (select batch_id, avg(age_xent) + avg(gender_xent) + (select penalty from penalty) as loss,
        avg(abs(pred_age - label)) as mae, avg(case when pred_gender = parity then 1.0 else 0.0 end) as acc
      from b group by 1)
select round(avg(mae), 6) as mean_error_age, round(avg(acc), 6) as mean_gender_acc, round(avg(loss), 6) as mean_loss from m
""")
def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model on all rows, in shuffled batches of 32, averaged over batches."""
    rows = _labelled(spark, sf_dir)
    result = evaluate(rows, _centroid_model(rows))
    return result.withColumns({c: F.round(c, 6) for c in result.columns})


@query("user_model", """
select vec_id as key, round(cast(list_sum(list_transform(embedding, lambda x: cast(x as double))) as double), 3) as prediction
from embeddings
""")
def user_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model loaded once per worker: here it adds up the features."""
    def make_predict_fn():
        import numpy as np

        return lambda x: np.asarray(x, dtype=np.float64).sum(axis=1)

    rows = fixtures.table(spark, sf_dir, "embeddings")
    from pyspark.sql.types import DoubleType

    scored = models.score(
        rows, make_predict_fn, "embedding", DoubleType(), batch_size=256, input_tensor_shapes=[[64]]
    )
    return scored.select(F.col("vec_id").alias("key"), F.round("prediction", 3).alias("prediction"))


_STREAMED = f"""
with {SCORED} select vec_id, age_label, gender_label, round(pred_age, 6) as pred_age, pred_gender from scored where idx = 0
"""


def _first_model(rows: DataFrame) -> DataFrame:
    return rows.select(
        "vec_id",
        F.col("label").alias("age_label"),
        (F.col("label") % 2).alias("gender_label"),
        F.slice("embedding", 1, 10).alias("age_logits"),
        F.slice("embedding", 51, 2).alias("gender_logits"),
    )


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The vectors written as a few files and scored as a stream; returns the output folders."""
    source = fixtures.table(spark, sf_dir, "embeddings")
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    source.repartition(4).write.parquet(arriving)
    stream = read_stream(spark, arriving, source.schema, max_files=2)
    started = score_stream(stream, _first_model, f"{out}/rows", f"{out}/state", f"{out}/metrics")
    started.awaitTermination()
    return f"{out}/rows", f"{out}/metrics"


@query("stream_score", _STREAMED)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = read_scored(spark, _streamed(spark, sf_dir)[0])
    return scored.withColumn("pred_age", F.round("pred_age", 6))


@query("stream_capped", _STREAMED)
def stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops at its cap and is run again without one: together all rows, each once."""
    source = fixtures.table(spark, sf_dir, "embeddings")
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    source.repartition(4).write.parquet(arriving)
    stream = read_stream(spark, arriving, source.schema, max_files=1)
    for cap in (1, None):
        await_scored(score_stream(stream, _first_model, f"{out}/rows", f"{out}/state", max_batches=cap))
    return read_scored(spark, f"{out}/rows").withColumn("pred_age", F.round("pred_age", 6))


@query("stream_metrics", f"""
with {SCORED} select cast(count(*) as bigint) as n_rows, cast(2 as bigint) as n_batches, round(avg(age_xent), 6) as age_xent,
  round(avg(gender_xent), 6) as gender_xent, round(avg(abs(pred_age - age_label)), 6) as age_mae,
  round(avg(case when gender_hit then 1.0 else 0.0 end), 6) as gender_acc
from scored where idx = 0
""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per micro-batch of two files each, four files in all; their means, weighted by rows."""
    per_batch = spark.read.parquet(_streamed(spark, sf_dir)[1])
    rows = F.sum("n_rows")
    return per_batch.agg(rows.alias("n_rows"), F.count(F.lit(1)).alias("n_batches"), *(
        F.round(F.sum(F.col(c) * F.col("n_rows")) / rows, 6).alias(c) for c in ("age_xent", "gender_xent", "age_mae", "gender_acc")))
