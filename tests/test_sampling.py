"""Order, splits, shards, epochs and batches."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from facetide.operators import sampling as s, selection, trace

few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def ids(spark, n, parts=4):
    return spark.range(0, n, 1, parts)


def md5_order(n, seed=2017):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())


@few
@given(n=st.integers(2, 300), share=st.floats(0.01, 0.9))
def test_split_sizes_order_and_complement(spark, n, share):
    n_test = math.ceil(n * share)
    if n_test == n:
        return
    train, test = s.split_exact(ids(spark, n), "id", test_size=share)
    first = {r["id"] for r in test.collect()}
    rest = {r["id"] for r in train.collect()}
    assert first == set(md5_order(n)[:n_test]) and rest == set(range(n)) - first


def test_split_by_train_share_and_counts(spark):
    train, test = s.split_exact(ids(spark, 999), "id", train_size=0.25)
    assert (train.count(), test.count()) == (249, 750)
    train, test = s.split_exact(ids(spark, 10), "id", test_size=0)
    assert (train.count(), test.count()) == (10, 0)
    train, test = s.split_exact(ids(spark, 10), "id", test_size=4)
    assert (train.count(), test.count()) == (6, 4)
    with pytest.raises(ValueError, match="leaves 0 for training"):
        s.split_exact(ids(spark, 10), "id", train_size=0.001)
    with pytest.raises(ValueError, match="give one"):
        s.split_exact(ids(spark, 10), "id")


def test_split_needs_no_shuffle(spark):
    train, test = s.split_exact(ids(spark, 1000), "id", test_size=0.1)
    for part in (train, test):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_split_refines_within_a_bucket(spark, monkeypatch):
    """One digit per pass makes the cut need several passes."""
    monkeypatch.setattr(s, "DIGITS", 1)
    train, test = s.split_exact(ids(spark, 500), "id", test_size=0.3)
    assert {r["id"] for r in test.collect()} == set(md5_order(500)[:150]) and train.count() == 350


def test_split_of_copies(spark):
    """A third of all rows is one row, copied."""
    df = ids(spark, 900).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    with pytest.raises(ValueError, match="repeats"):
        s.split_exact(df, "k", test_size=next(
            i for i, v in enumerate(sorted((hashlib.md5(f"2017|{k}".encode()).hexdigest(), k) for k in
                                           [-1] * 300 + [i for i in range(900) if i % 3])) if v[1] == -1) + 5)
    train, test = s.split_exact(df, "k", test_size=0.5, unique_key=False)
    assert (train.count(), test.count()) == (450, 450)
    assert train.unionByName(test).filter("k = -1").count() == 300
    numbered = s.number_shuffled(df, "k", unique_key=False)
    assert sorted(r["pos"] for r in numbered.collect()) == list(range(900))
    assert numbered.columns == ["k", "pos", "total"]
    # Rows that are no copies keep their order.
    single = [r["k"] for r in sorted(numbered.collect(), key=lambda r: r["pos"]) if r["k"] != -1]
    assert single == [k for k in md5_order(900) if k % 3]
    tasks = Counter(r["p"] for r in numbered.select(F.spark_partition_id().alias("p"), "k").collect() if r["k"] == -1)
    assert max(tasks.values()) < 80
    nulls = ids(spark, 90).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), (F.col("id") % 2).alias("j"))
    train, test = s.split_exact(nulls, ["k", "j"], test_size=0.5, unique_key=False)
    assert (train.count(), test.count()) == (45, 45)


def test_unique_keys_need_no_tie(spark):
    rows = s.number_shuffled(ids(spark, 200), "id", unique_key=False).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["pos"])] == md5_order(200)


@few
@given(n=st.integers(0, 300))
def test_shuffled_numbers(spark, n):
    rows = s.number_shuffled(ids(spark, n), "id").collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["pos"])] == md5_order(n)
    assert all(r["total"] == n for r in rows)


def test_limit_prunes_before_the_shuffle(spark):
    rows = s.number_shuffled(ids(spark, 5000), "id", limit=70).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["pos"])] == md5_order(5000)[:70]
    assert {r["total"] for r in rows} == {5000}


def test_numbers_in_a_given_order(spark):
    df = ids(spark, 1000).select("id", (F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 10).alias("g"))
    rows = s.number_rows(df, [F.col("g").desc(), "k"], num_partitions=6).collect()
    want = sorted(rows, key=lambda r: (-r["g"], r["k"]))
    assert [r["pos"] for r in want] == list(range(1000)) and {r["total"] for r in rows} == {1000}


def test_copies_spread_when_numbered(spark):
    """Equal rows get a tie-breaker, so no task has to hold all of them."""
    df = ids(spark, 3000, 8).select(F.lit(1).alias("same"))
    numbered = s.number_rows(df, ["same"], unique=False, num_partitions=6)
    tasks = Counter(r["p"] for r in numbered.select(F.spark_partition_id().alias("p"), "pos").collect())
    assert len(tasks) == 6 and max(tasks.values()) < 1500
    assert sorted(r["pos"] for r in numbered.collect()) == list(range(3000))


@few
@given(n=st.integers(0, 200), k=st.integers(1, 12))
def test_shards_are_even_and_contiguous(spark, n, k):
    rows = s.assign_shards(s.number_shuffled(ids(spark, n), "id"), k).collect()
    bounds = np.linspace(0, n, k + 1).astype(int)
    for r in rows:
        assert bounds[r["shard"]] <= r["pos"] < bounds[r["shard"] + 1]
    sizes = [sum(r["shard"] == i for r in rows) for i in range(k)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_number_of_test_shards():
    assert [s.n_test_shards(k) for k in (1, 3, 4, 5, 8, 9)] == [1, 1, 1, 2, 2, 3]


def test_epochs_run_on_and_batches_cross_them(spark):
    stream = s.shuffle_epochs(ids(spark, 50), "id", 3).collect()
    ordered = sorted(stream, key=lambda r: r["pos"])
    assert [r["pos"] for r in ordered] == list(range(150)) and {r["total"] for r in ordered} == {150}
    orders = [[r["id"] for r in ordered if r["epoch"] == e] for e in range(3)]
    assert all(sorted(o) == list(range(50)) for o in orders) and orders[0] != orders[1]
    assert [r["epoch"] for r in ordered] == sorted(r["epoch"] for r in ordered)
    batches = s.assign_batches(s.shuffle_epochs(ids(spark, 50), "id", 3), 40, drop_last=True)
    sizes = Counter(r["batch_id"] for r in batches.collect())
    assert sizes == {0: 40, 1: 40, 2: 40}
    kept = Counter(r["batch_id"] for r in s.assign_batches(s.number_shuffled(ids(spark, 50), "id"), 40).collect())
    assert kept == {0: 40, 1: 10}


@pytest.mark.parametrize("steps", [3, 20, 1000])
def test_capped_batches_are_the_first_ones(spark, steps):
    every = s.assign_batches(s.shuffle_epochs(ids(spark, 100), "id", 4), 10, drop_last=True)
    capped = s.training_batches(ids(spark, 100), "id", 4, 10, steps)
    want = sorted((r["batch_id"], r["epoch"], r["id"]) for r in every.collect() if r["batch_id"] < steps)
    assert sorted((r["batch_id"], r["epoch"], r["id"]) for r in capped.collect()) == want


def test_numbering_shuffles_once_and_sorts_per_task(spark):
    plan = s.number_shuffled(ids(spark, 1000), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Sort [_hash" in plan


def test_numbers_survive_unions_and_joins(spark):
    """The place in a task is taken where the rows are sorted, whatever is done with them later."""
    a, b = s.number_shuffled(ids(spark, 300), "id"), s.number_rows(ids(spark, 300), ["id"])
    both = a.unionByName(b).unionByName(s.number_shuffled(ids(spark, 300), "id", seed=5))
    assert Counter(r["pos"] for r in both.collect()) == {p: 3 for p in range(300)}
    joined = a.join(b.withColumnRenamed("pos", "q"), "id").orderBy("q").select("id", "pos", "q").collect()
    assert [r["q"] for r in joined] == list(range(300))
    assert [r["id"] for r in sorted(joined, key=lambda r: r["pos"])] == md5_order(300)
    assert a.repartition(3).groupBy().agg(F.sum("pos")).first()[0] == 300 * 299 // 2


def test_endless_repetition_is_refused(spark):
    with pytest.raises(ValueError, match="at least one epoch"):
        s.repeat_epochs(ids(spark, 3), 0)


@pytest.mark.parametrize("block", [100, 700, 1_000_000])
def test_durations_across_blocks(spark, block):
    rng = np.random.default_rng(1)
    rows = [(run, int(step), int(step * 3 + run)) for run in range(3)
            for step in np.flatnonzero(rng.random(5000) < 0.6)]
    df = spark.createDataFrame(rows, "run int, step long, t long").select(
        "run", "step", F.timestamp_seconds("t").alias("ts"))
    got = {(r["run"], r["step"]): r["seconds"] for r in trace.step_durations(df, ["run"], block=block).collect()}
    want = {}
    for run in range(3):
        last = None
        for _, step, t in sorted(r for r in rows if r[0] == run and r[1] % 100 == 0):
            want[run, step] = None if last is None else float(t - last)
            last = t
    assert got == want


def test_checkpoint_retention(spark):
    rows = [(run, step, f"{run}-{step}") for run in "ab" for step in range(0, 50, 5)]
    df = spark.createDataFrame(rows, "run string, step long, path string")
    kept = selection.retain_last(df, 3)
    assert sorted(r["path"] for r in kept.collect()) == ["a-35", "a-40", "a-45", "b-35", "b-40", "b-45"]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    assert {r["path"] for r in selection.latest(df).collect()} == {"a-45", "b-45"}


def test_different_keys_have_different_hashes(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a", "\\N"), ("a\\", "|c"), ("a\\|", "c"), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(s.order_hash(1, "x", "y").alias("h")).distinct().count() == len(rows)


def test_runs_without_a_name_keep_their_rows(spark):
    rows = [(None, i, i // 100) for i in range(0, 300, 100)] + [("r", i, i // 50) for i in range(0, 300, 100)]
    df = spark.createDataFrame(rows, "run string, step long, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = sorted((r["run"] or "", r["step"], r["seconds"]) for r in trace.step_durations(df, ["run"]).collect() if r["seconds"] is not None)
    assert got == [("", 100, 1.0), ("", 200, 1.0), ("r", 100, 2.0), ("r", 200, 2.0)]
    assert trace.step_durations(df, ["run"]).count() == 6
