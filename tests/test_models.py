"""Metrics, model choice, training, evaluation, streaming."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from facetide.operators import metrics, models, selection, trace, training
from facetide.plans.evaluate import choose_best_model, evaluate, evaluate_models
from facetide.plans.infer import infer
from facetide.sources import files
from facetide.streaming.score import await_scored, read_scored, read_stream, score_stream


def softmax(x):
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def expected_metrics(age_logits, gender_logits, age, gender, batch):
    n = np.arange(len(age))
    pa, pg = softmax(age_logits), softmax(gender_logits)
    ax, gx = -np.log(pa[n, age]), -np.log(pg[n, gender])
    err = np.abs(pa @ np.arange(pa.shape[1]) - age)
    hit = (gender_logits > gender_logits[n, gender][:, None]).sum(axis=1) < 1
    return {b: tuple(v[batch == b].mean() for v in (ax, gx, err, hit)) for b in np.unique(batch)}


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    age_logits, gender_logits = rng.normal(size=(70, 101)), rng.normal(size=(70, 2)).round(0)
    age, gender, batch = rng.integers(0, 101, 70), rng.integers(0, 2, 70), np.arange(70) // 32
    df = spark.createDataFrame(
        [(int(a), int(g), x.tolist(), y.tolist(), int(b)) for a, g, x, y, b in
         zip(age, gender, age_logits, gender_logits, batch)],
        "age_label int, gender_label int, age_logits array<double>, gender_logits array<double>, batch_id long",
    )
    return df, expected_metrics(age_logits, gender_logits, age, gender, batch)


def test_batch_metrics_and_mean_of_means(scored):
    df, want = scored
    got = {r["batch_id"]: (r["age_xent"], r["gender_xent"], r["age_mae"], r["gender_acc"])
           for r in metrics.batch_metrics(df).collect()}
    assert got.keys() == want.keys()
    for b in want:
        np.testing.assert_allclose(got[b], want[b], rtol=1e-9)
    row = metrics.evaluate_all(df, [], 0.5).first()
    means = np.mean([want[b] for b in want], axis=0)
    np.testing.assert_allclose(
        [row["mean_error_age"], row["mean_gender_acc"], row["mean_loss"]], [means[2], means[3], means[0] + means[1] + 0.5]
    )


def test_penalty_as_a_table(spark, scored):
    df, want = scored
    weights = spark.createDataFrame([([1.0, 2.0],), ([3.0],)], "weights array<double>")
    total = metrics.with_total_loss(metrics.batch_metrics(df), metrics.l2_total(weights, decay=0.1))
    for r in total.collect():
        np.testing.assert_allclose(r["total_loss"], sum(want[r["batch_id"]][:2]) + 0.7)
    assert metrics.l2_total(weights.filter("false")).first()[0] == 0.0


RESULTS = "idx int, path string, mean_gender_acc double, mean_error_age double"


@pytest.mark.parametrize("rows, best", [
    ([(0, "a", 0.5, 9.0), (1, "b", 0.7, 8.0), (2, "c", 0.7, 8.0)], (0.7, "b", 8.0, "b")),
    ([(0, "a", 0.0, 100.0), (1, "b", 0.0, 150.0)], (0.0, "a", 100.0, "a")),
    ([(0, "a", 0.0, 100.0), (1, "b", 0.1, 99.0)], (0.1, "b", 99.0, "b")),
    ([(0, "a", float("nan"), float("nan")), (1, "b", 0.1, 50.0)], (0.1, "b", 50.0, "b")),
    ([(1, "b", None, None), (0, "a", None, None)], (0.0, "a", 100.0, "a")),
])
def test_choice_of_the_best_model(spark, rows, best):
    row = selection.choose_best(spark.createDataFrame(rows, RESULTS)).first()
    assert (row["best_gender_acc"], row["gender_model"], row["best_age_mae"], row["age_model"]) == best


def test_metric_log_appends(spark, tmp_path):
    wide = spark.createDataFrame([(1, 0.5, 2.0), (2, 0.25, 3.0)], "step int, loss double, acc double")
    for run in ("a", "b", "a"):
        trace.log_metrics(trace.metric_rows(wide, run, ["loss", "acc"]), str(tmp_path / "log"))
    log = trace.read_metrics(spark, str(tmp_path / "log"))
    assert log.count() == 12 and log.filter("run = 'a'").count() == 8
    assert log.filter("name = 'loss'").agg(F.sum("value")).first()[0] == 2.25


@pytest.fixture(scope="module")
def clustered(spark):
    """Points around one centre per age, genders by parity."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8)) * 3
    age = np.arange(240) % 6
    x = centres[age] + rng.normal(size=(240, 8)) * 0.3
    return spark.createDataFrame(
        [(i, v.tolist(), int(a), int(a % 2)) for i, (v, a) in enumerate(zip(x, age))],
        "key long, features array<float>, age int, gender int",
    ).repartition(4).cache()


def test_full_batch_training(spark, clustered, tmp_path):
    model = training.train_two_head(clustered, max_iter=50)
    assert model.age.shape == (101, 9) and model.gender.shape == (2, 9)
    # Ages that no training row has can be tested.
    unseen = clustered.withColumn("age", F.col("age") + 90)
    assert evaluate(unseen, model).first()["mean_error_age"] > 50
    path = models.save_model(spark, model, str(tmp_path / "m"))
    again = models.load_model(spark, path)
    np.testing.assert_array_equal(again.age, model.age)
    row = evaluate(clustered, again).first()
    assert row["mean_gender_acc"] == 1.0 and row["mean_error_age"] < 0.2
    loss = metrics.l2_total(models.weights_table(spark, path)).first()[0]
    assert abs(loss - model.penalty) < 1e-12


def reference_adam(rows, order, steps, size, lr, model):
    """The same optimizer in plain numpy."""
    w = [model.age.copy(), model.gender.copy()]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(steps):
        part = [rows[k] for k in order[step * size:(step + 1) * size]]
        x = np.column_stack([np.array([p[0] for p in part]), np.ones(size)])
        for i in range(2):
            y = np.array([p[1 + i] for p in part])
            p = softmax(x @ w[i].T)
            p[np.arange(size), y] -= 1
            g = p.T @ x / size
            g[:, :-1] += 1e-5 * w[i][:, :-1]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            t = step + 1
            w[i] = w[i] - lr * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m[i] / (np.sqrt(v[i]) + 1e-8)
    return w


def test_adam_matches_numpy_and_resumes(spark, clustered, tmp_path):
    import hashlib

    options = dict(epochs=2, batch_size=60, lr=0.05, age_classes=6)
    whole, log = training.train_sgd(clustered, steps=6, **options)
    assert whole.step == 6
    order = [k for e in range(2) for k in
             sorted(range(240), key=lambda k: hashlib.md5(f"2017|{e}|{k}".encode()).hexdigest())]
    rows = {r["key"]: (r["features"], r["age"], r["gender"]) for r in clustered.collect()}
    want = reference_adam(rows, order, 6, 60, 0.05, training.initial_model(8, 2017, 6))
    np.testing.assert_allclose(whole.age, want[0], atol=1e-8)
    np.testing.assert_allclose(whole.gender, want[1], atol=1e-8)

    values = {(r["step"], r["name"]): r["value"] for r in log.collect()}
    assert len(values) == 6 * 6 and values[0, "lr"] == 0.05
    assert values[5, "total loss"] < values[0, "total loss"]
    assert abs(values[0, "age_cross_entropy"] - np.log(6)) < 0.1

    folder = str(tmp_path / "m")
    training.train_sgd(clustered, steps=4, model_dir=folder, save_every=2, **options)
    assert [p.rsplit("=")[-1] for p in models.checkpoints(spark, folder)] == ["000000001", "000000003", "000000004"]
    resumed, log = training.train_sgd(clustered, steps=6, model_dir=folder, **options)
    np.testing.assert_allclose(resumed.age, whole.age, atol=1e-12)
    assert min(r["step"] for r in log.collect()) == 4
    best, results = choose_best_model(clustered, folder)
    assert results.count() == len(models.checkpoints(spark, folder)) == 4
    assert best.first()["age_model"] == models.latest_checkpoint(spark, folder)
    table = models.registry_table(spark, folder, "r")
    assert selection.latest(table).first()["path"] == models.latest_checkpoint(spark, folder)


def test_all_steps_between_checkpoints_are_one_job(spark, clustered, tmp_path):
    sc = spark.sparkContext
    options = dict(epochs=2, batch_size=60, lr=0.05, age_classes=6, steps=7)
    jobs = []
    for save_every, group in ((1000, "long"), (3, "short")):
        sc.setJobGroup(group, group)
        training.train_sgd(clustered, model_dir=str(tmp_path / group), save_every=save_every, resume=False, **options)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(group)))
    sc.setJobGroup("plain", "plain")
    plain, _ = training.train_sgd(clustered, **options)
    jobs.append(len(sc.statusTracker().getJobIdsForGroup("plain")))
    sc._jsc.clearJobGroup()
    assert jobs[0] - jobs[2] <= 8 and jobs[1] > jobs[0]
    tracked = models.load_model(spark, models.latest_checkpoint(spark, str(tmp_path / "short")))
    np.testing.assert_allclose(tracked.age, plain.age, atol=1e-12)
    assert [p.rsplit("=")[-1] for p in models.checkpoints(spark, str(tmp_path / "short"))] == [
        "000000001", "000000004", "000000007"]


def test_a_job_for_each_step_gives_the_same_weights(spark, clustered, monkeypatch):
    options = dict(epochs=2, batch_size=60, lr=0.05, age_classes=6, steps=5)
    one, log = training.train_sgd(clustered, **options)
    monkeypatch.setattr(training, "_tasks", lambda slots, model: 50)  # more than run at once
    other, again = training.train_sgd(clustered, **options)
    np.testing.assert_allclose(one.age, other.age, atol=1e-12)
    for a, b in zip(log.orderBy("name", "step").collect(), again.orderBy("name", "step").collect()):
        assert a[:2] == b[:2] and abs(a["value"] - b["value"]) < 1e-12


def test_small_batches_wait_for_no_exchange(clustered):
    """A step of a barrier stage takes a second at least, whatever its work."""
    model, log = training.train_sgd(clustered, epochs=1, batch_size=4, steps=None, age_classes=6)
    took = [r["ts"].timestamp() for r in log.select("ts").collect()]
    assert model.step == 60 and len(took) == 60 * len(training.TRACE)
    assert max(took) - min(took) < 40


def test_shared_and_own_batches_give_the_same_weights(spark, clustered, tmp_path, monkeypatch):
    """In stretches, in a barrier stage, and in a job for each step; also resumed within a stretch."""
    assert training._alone(64, training.initial_model(64, 0)) and not training._alone(8192, training.initial_model(1792, 0))
    options = dict(epochs=2, batch_size=20, lr=0.05, age_classes=6)
    found = [training.train_sgd(clustered, steps=9, **options)]
    folder = str(tmp_path / "m")
    training.train_sgd(clustered, steps=4, model_dir=folder, save_every=3, **options)
    found.append(training.train_sgd(clustered, steps=9, model_dir=folder, save_every=3, **options))
    assert min(r["step"] for r in found[1][1].collect()) == 4
    monkeypatch.setattr(training, "EXCHANGE_SECONDS", 0)
    found.append(training.train_sgd(clustered, steps=9, **options))
    monkeypatch.setattr(training, "_tasks", lambda slots, model: 50)
    found.append(training.train_sgd(clustered, steps=9, **options))
    for model, log in found[1:]:
        assert model.step == 9
        np.testing.assert_allclose(model.age, found[0][0].age, atol=1e-12)
        np.testing.assert_allclose(model.gender, found[0][0].gender, atol=1e-12)
    for k in (2, 3):
        a, b = ({(r["step"], r["name"]): r["value"] for r in found[i][1].collect()} for i in (0, k))
        assert a.keys() == b.keys() and len(a) == 9 * len(training.TRACE) and all(abs(a[x] - b[x]) < 1e-9 for x in a)


def test_tasks_are_bounded_by_what_they_exchange():
    assert training._tasks(1000, training.initial_model(64, 0)) == 30
    assert training._tasks(1000, training.initial_model(1792, 0)) == 5
    assert training._tasks(4, training.initial_model(64, 0)) == 4
    assert training._tasks(4, training.initial_model(10**6, 0)) == 1


def test_the_trace_is_kept_while_training(spark, clustered, tmp_path, monkeypatch):
    """A run that fails after some checkpoints has left its log up to there; the resumed run goes on with it."""
    from facetide.operators import trace

    options = dict(epochs=2, batch_size=60, lr=0.05, age_classes=6, model_dir=str(tmp_path / "m"), save_every=2,
                   log_dir=str(tmp_path / "log"), run="r")
    saved = training.save_model
    monkeypatch.setattr(training, "save_model", lambda spark, model, folder: (_ for _ in ()).throw(RuntimeError("killed"))
                        if model.step > 3 else saved(spark, model, folder))
    with pytest.raises(RuntimeError, match="killed"):
        training.train_sgd(clustered, steps=7, **options)
    log = trace.read_trace(spark, str(tmp_path / "log"))
    assert sorted(r["step"] for r in log.collect()) == [0, 1, 2]
    monkeypatch.setattr(training, "save_model", saved)
    training.train_sgd(clustered, steps=7, **options)
    timed = trace.step_durations(trace.read_trace(spark, str(tmp_path / "log")), ["run"], every=2).orderBy("step").collect()
    assert [r["step"] for r in timed] == [0, 2, 4, 6] and timed[0]["seconds"] is None
    assert all(r["seconds"] > 0 for r in timed[1:])
    assert spark.read.parquet(str(tmp_path / "log")).count() == 7 * len(training.TRACE)


def test_the_query_trains_on_every_full_batch(spark, sf_dir, monkeypatch):
    from facetide.plans import queries_learning

    few = tuple(2 if d == 1000 else d for d in training.train_sgd.__defaults__)
    monkeypatch.setattr(training.train_sgd, "__defaults__", few)  # the default cap is below the table's batches
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert {r["steps"] for r in queries_learning.train_sgd(spark, sf_dir).collect()} == {n // queries_learning.BATCH}


def test_repeated_keys_are_refused(clustered):
    with pytest.raises(ValueError, match="unique"):
        training.train_sgd(clustered.withColumn("key", F.col("key") % 7), steps=1)


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    model, folder = training.initial_model(3, 1, 4), str(tmp_path / "m")
    with ThreadPoolExecutor(6) as pool:
        paths = list(pool.map(lambda step: models.save_model(
            spark, models.TwoHeadModel(model.age + step, model.gender, step), folder), range(6)))
    assert sorted(paths) == models.checkpoints(spark, folder) and len({p.split("save=")[1][:6] for p in paths}) == 6
    assert [p.rsplit("=", 1)[1] for p in paths] == [f"{k:09d}" for k in range(6)]
    assert not [n for n in os.listdir(folder) if n.startswith("_saving")]
    spark.sparkContext.setJobGroup("load", "load")
    loaded = models.load_models(spark, paths)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("load")) <= 1
    spark.sparkContext._jsc.clearJobGroup()
    for step, m in enumerate(loaded):
        np.testing.assert_array_equal(m.age, model.age + step)
        assert m.step == step and m.gender.shape == model.gender.shape


def test_a_save_number_is_claimed_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    folder, begin = files.qualified(spark, str(tmp_path)), Barrier(6)

    def claim(number):
        begin.wait()
        return models._claimed(spark, folder, number)

    with ThreadPoolExecutor(6) as pool:
        for number in range(1, 51):
            assert sum(pool.map(claim, [number] * 6)) == 1


def test_a_checkpoint_that_was_not_finished_is_not_seen(spark, tmp_path):
    model, folder = training.initial_model(3, 1, 4), str(tmp_path / "m")
    models.save_model(spark, model, folder)
    os.makedirs(f"{folder}/_saving-abc")
    open(f"{folder}/_claims/000002", "w").close()  # a writer that died after its claim
    path = models.save_model(spark, models.TwoHeadModel(model.age, model.gender, 5), folder)
    assert path.endswith("save=000003-step=000000005") and models.latest_checkpoint(spark, folder) == path
    assert len(models.checkpoints(spark, folder)) == 2


def test_old_checkpoints_are_dropped(spark, tmp_path):
    model = training.initial_model(3, 1, 4)
    for step in range(5):
        models.save_model(spark, models.TwoHeadModel(model.age, model.gender, step), str(tmp_path), keep=2)
    assert [p[-1] for p in models.checkpoints(spark, str(tmp_path))] == ["3", "4"]
    # The latest is the one saved last, also if its step is lower, and it is not dropped.
    path = models.save_model(spark, models.TwoHeadModel(model.age, model.gender, 0), str(tmp_path), keep=2)
    assert models.latest_checkpoint(spark, str(tmp_path)) == path and models.load_model(spark, path).step == 0
    assert models.save_model(spark, models.TwoHeadModel(model.age, model.gender, 0), str(tmp_path), keep=2) == path
    with pytest.raises(ValueError, match="at least"):
        models.save_model(spark, model, str(tmp_path), keep=0)
    with pytest.raises(FileNotFoundError):
        choose_best_model(spark.range(1), str(tmp_path / "none"))


def test_models_beyond_the_broadcast_bound_are_scored_in_passes(clustered, monkeypatch):
    pair = [(f"m{i}", training.initial_model(8, i, 6)) for i in range(3)]
    together = evaluate_models(clustered, pair).collect()
    monkeypatch.setattr(models, "MAX_MODEL_BYTES", 1)
    apart = evaluate_models(clustered, pair).collect()
    assert sorted(together) == sorted(apart) and len(apart) == 3


def test_measures_equal_the_expressions_on_logits(clustered):
    """Two ways to the same numbers: numpy next to the model, and JVM expressions on a table of logits."""
    pair = [(f"m{i}", training.initial_model(8, i, 6)) for i in range(2)]
    rows = clustered.select("key", "features", F.col("age").alias("age_label"), F.col("gender").alias("gender_label"))
    here = models.measure_models(rows, pair)
    there = metrics.score_rows(models.score_models(rows, pair))
    names = sorted(here.columns)
    assert names == sorted(there.columns)
    for a, b in zip(*(df.select(*names).orderBy("key", "idx").collect() for df in (here, there))):
        for n in names:
            assert a[n] == b[n] or abs(a[n] - b[n]) < 1e-9, n
    with pytest.raises(Exception, match="label outside 0..5"):
        models.measure_models(rows.withColumn("age_label", F.lit(6)), pair).collect()


def test_ragged_features_are_refused(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1, 1), (1, [1.0], 1, 1), (2, [1.0, 2.0, 3.0], 1, 1)],
                               "key long, features array<double>, age int, gender int").coalesce(1)
    with pytest.raises(Exception, match="equal length"):
        models.predict(df, training.initial_model(2, 0, 4)).collect()


def test_predictions_as_text(spark, clustered, tmp_path):
    model = training.train_two_head(clustered, max_iter=30)
    infer(clustered, model, str(tmp_path / "out"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == 240 and all("Real Gender/Age: " in line for line in lines)
    right = sum(line.split("Age: ")[1].split("/")[0] == line.split("Predicted Gender/Age: ")[1].split("/")[0]
                for line in lines)
    assert right == 240


def test_user_model(clustered):
    def make():
        return lambda x: x.sum(axis=1)

    out = models.score(clustered, make, "features", DoubleType(), input_tensor_shapes=[[8]])
    for r in out.limit(20).collect():
        assert abs(r["prediction"] - sum(r["features"])) < 1e-4


def stream_logits(model):
    def logits(df):
        labelled = df.withColumnRenamed("age", "age_label").withColumnRenamed("gender", "gender_label")
        return models.score_models(labelled, [("m", model)]).drop("idx", "path", "penalty")

    return logits


def test_stream_equals_batch_and_stops_at_the_cap(spark, clustered, tmp_path):
    model = training.initial_model(8, 5, 6)
    source = str(tmp_path / "in")
    clustered.repartition(6).write.parquet(source)
    rows = read_stream(spark, source, clustered.schema, max_files=2)
    score_stream(rows, stream_logits(model), str(tmp_path / "out"), str(tmp_path / "state"),
                 str(tmp_path / "metrics")).awaitTermination()
    got = {r["key"]: (r["pred_gender"], round(r["pred_age"], 9)) for r in read_scored(spark, str(tmp_path / "out")).collect()}
    want = {r["key"]: (r["pred_gender"], round(r["pred_age"], 9)) for r in models.predict(clustered, model).collect()}
    assert got == want and len(got) == 240
    per_batch = spark.read.parquet(str(tmp_path / "metrics"))
    assert per_batch.count() == 3 and per_batch.agg(F.sum("n_rows")).first()[0] == 240
    # Nothing new has come: running again adds nothing.
    again = score_stream(rows, stream_logits(model), str(tmp_path / "out"), str(tmp_path / "state"))
    again.awaitTermination()
    assert read_scored(spark, str(tmp_path / "out")).count() == 240

    capped = str(tmp_path / "capped"), str(tmp_path / "state2")
    await_scored(score_stream(rows, stream_logits(model), *capped, max_batches=1))
    assert 70 < read_scored(spark, capped[0]).count() < 90  # two files of six
    # Without the cap the rest comes, and nothing twice.
    await_scored(score_stream(rows, stream_logits(model), *capped))
    again = {r["key"]: (r["pred_gender"], round(r["pred_age"], 9)) for r in read_scored(spark, capped[0]).collect()}
    assert again == want and read_scored(spark, capped[0]).count() == 240


def test_only_measures_are_put_in_order(spark, clustered):
    """No feature vector is below an exchange, for one model or several."""
    from facetide.plans.evaluate import evaluate_batches

    pair = [(f"m{i}", training.initial_model(8, i, 6)) for i in range(2)]
    for df in (evaluate_models(clustered, pair[:1]), evaluate_models(clustered, pair), evaluate_batches(clustered, pair[0][1])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "features" not in plan and "MapInArrow" not in plan
    batches = evaluate_batches(clustered, pair[0][1])
    assert batches.count() == 8 and batches.agg(F.sum("n_rows")).first()[0] == 240


def test_labels_do_not_matter_to_predictions(spark, clustered):
    model = training.initial_model(8, 1, 6)
    odd = clustered.withColumns({"age": F.when(F.col("key") % 2 == 0, F.lit(150)), "gender": F.lit(None).cast("int")})
    want = {r["key"]: (r["pred_gender"], r["pred_age"]) for r in models.predict(clustered, model).collect()}
    rows = models.predict(odd, model).collect()
    assert {r["key"]: (r["pred_gender"], r["pred_age"]) for r in rows} == want
    assert {r["real_age"] for r in rows} == {None, 150}
