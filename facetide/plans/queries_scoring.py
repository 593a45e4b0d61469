"""Queries over logits and vectors: array functions, losses, batch metrics, model choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide import fixtures
from facetide.catalog import query
from facetide.functions import (
    argmax, expected_index, in_top_k, l2_penalty, reverse_channels, softmax, sparse_xent, standardize,
)
from facetide.operators import metrics, selection, trace
from facetide.plans.views import BATCHES, LOGITS, PROBS, SCORED
from facetide.session import scratch_path
from facetide.sources.tables import result_lines, write_predictions_text


def _elements(df: DataFrame, keys: list[str], values: str) -> DataFrame:
    """One row per array element, so that results compare as plain numbers."""
    return df.select(*keys, F.posexplode(values).alias("i", "v"))


@query("standardize", """
with v as (select vec_id, cast(embedding as double[]) as x from embeddings),
m as (select vec_id, x, list_sum(x) / len(x) as mu from v),
s as (select *, sqrt(list_sum(list_transform(x, lambda e: (e - mu) * (e - mu))) / len(x)) as sd from m),
z as (select vec_id, list_transform(x, lambda e: (e - mu) / greatest(sd, 1 / sqrt(len(x)))) as z from s)
select vec_id, cast(unnest(range(len(z))) as int) as i, round(unnest(z), 6) as v from z
""")
def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id", standardize("embedding").alias("z"))
    return _elements(vectors, ["vec_id"], "z").withColumn("v", F.round("v", 6))


@query("reverse_channels", """
select vec_id, cast(i as int) as i,
  round(cast(embedding[cast(i // 4 * 4 + 3 - i % 4 + 1 as int)] as double), 6) as v
from embeddings, range(64) t(i)
""")
def reversed_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of four over all 64 elements: the array stands for an image of 16 pixels with four channels."""
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id", reverse_channels("embedding", 4).alias("r"))
    return _elements(vectors, ["vec_id"], "r").withColumn("v", F.round(F.col("v").cast("double"), 6))


@query("softmax_heads", f"""
with {PROBS}
select idx, vec_id, 'age' as head, cast(unnest(range(len(pa))) as int) as i, round(unnest(pa), 6) as v from probs
union all
select idx, vec_id, 'gender', cast(unnest(range(len(pg))) as int), round(unnest(pg), 6) from probs
""")
def softmax_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.logits(spark, sf_dir)
    heads = rows.select(
        "idx", "vec_id",
        F.explode(F.array(
            F.struct(F.lit("age").alias("head"), softmax("age_logits").alias("p")),
            F.struct(F.lit("gender").alias("head"), softmax("gender_logits").alias("p")),
        )).alias("h"),
    ).select("idx", "vec_id", "h.head", "h.p")
    return _elements(heads, ["idx", "vec_id", "head"], "p").withColumn("v", F.round("v", 6))


@query("expected_age", f"with {SCORED} select idx, vec_id, round(pred_age, 6) as pred_age from scored")
def expected_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.logits(spark, sf_dir).select(
        "idx", "vec_id", F.round(expected_index(softmax("age_logits")), 6).alias("pred_age")
    )


@query("argmax_gender", f"with {SCORED} select idx, vec_id, pred_gender from scored")
def argmax_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.logits(spark, sf_dir).select("idx", "vec_id", argmax("gender_logits").alias("pred_gender"))


@query("in_top_k", f"""
with {LOGITS}
select idx, vec_id,
  len(list_filter(gender_logits, lambda x: x > gender_logits[gender_label + 1])) < 1 as gender_top1,
  len(list_filter(age_logits, lambda x: x > age_logits[age_label + 1])) < 3 as age_top3
from logits
""")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.logits(spark, sf_dir).select(
        "idx", "vec_id",
        in_top_k("gender_logits", "gender_label", 1).alias("gender_top1"),
        in_top_k("age_logits", "age_label", 3).alias("age_top3"),
    )


@query("sparse_xent", f"""
with {SCORED} select idx, vec_id, round(age_xent, 6) as age_xent, round(gender_xent, 6) as gender_xent from scored
""")
def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.logits(spark, sf_dir).select(
        "idx", "vec_id",
        F.round(sparse_xent("age_logits", "age_label"), 6).alias("age_xent"),
        F.round(sparse_xent("gender_logits", "gender_label"), 6).alias("gender_xent"),
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("batch_metrics", f"""
with {BATCHES}
select idx, batch_id, n_rows, round(age_xent, 6) as age_xent, round(gender_xent, 6) as gender_xent,
  round(age_mae, 6) as age_mae, round(gender_acc, 6) as gender_acc
from batches
""")
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = metrics.batch_metrics(fixtures.logits(spark, sf_dir), ["idx", "batch_id"])
    return _rounded(batches, "age_xent", "gender_xent", "age_mae", "gender_acc")


@query("mean_of_means", f"""
with {BATCHES}
select idx, round(avg(age_mae), 6) as mean_error_age, round(avg(gender_acc), 6) as mean_gender_acc
from batches group by idx
""")
def mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = metrics.batch_metrics(fixtures.logits(spark, sf_dir), ["idx", "batch_id"])
    return _rounded(metrics.mean_of_means(batches, ["idx"]), "mean_error_age", "mean_gender_acc")


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors as weight tensors."""
    return fixtures.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("weights"))


@query("l2_penalty", """
select vec_id, round(1e-5 * list_sum(list_transform(embedding, lambda w: cast(w as double) * w)) / 2, 12) as penalty
from embeddings
""")
def l2_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir).select(
        "vec_id", F.round(l2_penalty("weights", metrics.HEAD_DECAY), 12).alias("penalty")
    )


@query("total_loss", f"""
with {BATCHES}
select idx, batch_id, round(gender_xent + age_xent + penalty, 6) as total_loss from batches, penalty
""")
def total_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = metrics.batch_metrics(fixtures.logits(spark, sf_dir), ["idx", "batch_id"])
    total = metrics.with_total_loss(batches, metrics.l2_total(_weights(spark, sf_dir)))
    return _rounded(total.select("idx", "batch_id", "total_loss"), "total_loss")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.logits(spark, sf_dir)
    return metrics.evaluate_all(rows, ["idx"], metrics.l2_total(_weights(spark, sf_dir))).withColumn(
        "path", F.format_string("ckpt-%d", "idx")
    )


_RESULTS = f"""{BATCHES},
results as (
  select idx, concat('ckpt-', cast(idx as varchar)) as path, avg(age_mae) as mean_error_age,
    avg(gender_acc) as mean_gender_acc, avg(gender_xent + age_xent + penalty) as mean_loss
  from batches, penalty group by idx)"""


@query("evaluate_all", f"""
with {_RESULTS}
select idx, path, round(mean_error_age, 6) as mean_error_age, round(mean_gender_acc, 6) as mean_gender_acc,
  round(mean_loss, 6) as mean_loss
from results
""")
def evaluate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_results(spark, sf_dir), "mean_error_age", "mean_gender_acc", "mean_loss")


@query("choose_best", f"""
with {_RESULTS},
g as (select * from results where mean_gender_acc > 0 order by mean_gender_acc desc, idx limit 1),
a as (select * from results where mean_error_age < 100 order by mean_error_age, idx limit 1)
select round(g.mean_gender_acc, 6) as best_gender_acc, g.path as gender_model,
  round(a.mean_error_age, 6) as best_age_mae, a.path as age_model
from g, a
""")
def choose_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(selection.choose_best(_results(spark, sf_dir)), "best_gender_acc", "best_age_mae")


@query("metric_log", f"""
with {BATCHES},
runs as (select concat('model-', cast(idx as varchar)) as run, batch_id as step, * from batches)
select run, step, 'age_mae' as name, round(age_mae, 6) as value from runs
union all select run, step, 'gender_acc', round(gender_acc, 6) from runs
""")
def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch metrics appended to a log in two writes, then read back."""
    log = scratch_path(spark, "metrics")
    batches = metrics.batch_metrics(fixtures.logits(spark, sf_dir), ["idx", "batch_id"])
    for name in ("age_mae", "gender_acc"):
        rows = trace.metric_rows(batches, F.format_string("model-%d", "idx"), [name], step="batch_id")
        trace.log_metrics(rows, log)
    return _rounded(trace.read_metrics(spark, log), "value")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.score_rows(fixtures.logits(spark, sf_dir)).select(
        F.timestamp_micros(F.lit(1546300800000000) + F.col("vec_id") * 500000).alias("ts"),
        F.col("gender_label").alias("real_gender"),
        F.col("age_label").alias("real_age"),
        "pred_gender",
        F.format_string("%.3f", "pred_age").alias("pred_age"),
    )


_LINES = f"""
with {SCORED}, timed as (select *, make_timestamp(1546300800000000 + vec_id * 500000) as ts from scored)
select concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), case when vec_id % 2 = 0 then '' else '.500000' end,
  printf(' Real Gender/Age: %d/%d, Predicted Gender/Age: %d/%.3f', gender_label, age_label, pred_gender, pred_age)) as value
from timed
"""


@query("result_lines", _LINES)
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_lines(_predictions(spark, sf_dir))


@query("prediction_text", _LINES)
def prediction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines written as text and read back."""
    path = scratch_path(spark, "predictions")
    write_predictions_text(_predictions(spark, sf_dir), path)
    return spark.read.text(path)
