"""Training the two heads: full-batch with MLlib, and step by step with Adam."""

from __future__ import annotations

import base64
import io
import math
import time
from collections.abc import Iterator

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from facetide.functions.schedule import DECAY_RATE, DECAY_STEPS
from facetide.operators.metrics import HEAD_DECAY
from facetide.operators.models import (
    AGE_CLASSES, GENDER_CLASSES, TwoHeadModel, latest_checkpoint, load_model, matrix, measures, n_partials,
    save_model,
)
from facetide.operators.sampling import SPLIT_SEED, training_batches
from facetide.operators.trace import SAVE_EVERY, log_metrics
from facetide.session import ship

# The optimizer's decay rates and epsilon, the spread of initial weights, and the trace's metric names.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
INIT_STDDEV = 0.01
#: What tasks send each other in a step, all together: every task's sums go to every task.
EXCHANGE_BYTES = 64 << 20
#: Tasks of a barrier stage ask for each other's sums once a second. A batch whose work (multiply-adds a second) is done
#: sooner is not shared.
EXCHANGE_SECONDS, WORK_A_SECOND = 1.0, 1e9
TRACE = ("age_cross_entropy", "gender_cross_entropy", "total loss", "train_abs_age_error", "gender_accuracy", "lr")


def train_two_head(df: DataFrame, features: str = "features", age: str = "age", gender: str = "gender",
                   reg: float = HEAD_DECAY, max_iter: int = 100) -> TwoHeadModel:
    """Fit both softmax heads on the whole data with MLlib (distributed gradients, quasi-Newton steps).

    The heads always have all their classes, also those without a label here.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = df.select(
        array_to_vector(F.col(features)).alias("x"),
        F.col(age).cast("double").alias("age"),
        F.col(gender).cast("double").alias("gender"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    heads = []
    for label, classes in (("age", AGE_CLASSES), ("gender", GENDER_CLASSES)):
        nominal = {"ml_attr": {"type": "nominal", "num_vals": classes}}
        fitted = LogisticRegression(
            featuresCol="x", labelCol=label, family="multinomial", regParam=reg, maxIter=max_iter,
            standardization=False,
        ).fit(rows.withMetadata(label, nominal))
        heads.append(np.column_stack([fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()]))
    rows.unpersist()
    return TwoHeadModel(*heads)


def initial_model(n_features: int, seed: int, age_classes: int = AGE_CLASSES) -> TwoHeadModel:
    """Small random weights, redrawn beyond two standard deviations; zero biases."""
    rng = np.random.default_rng(seed)
    heads = []
    for classes in (age_classes, GENDER_CLASSES):
        w = rng.standard_normal((classes, n_features))
        while (far := np.abs(w) > 2).any():
            w[far] = rng.standard_normal(int(far.sum()))
        heads.append(np.column_stack([w * INIT_STDDEV, np.zeros(classes)]))
    return TwoHeadModel(*heads)


def train_sgd(df: DataFrame, key: str = "key", features: str = "features", age: str = "age", gender: str = "gender",
              epochs: int = 6, batch_size: int = 128, steps: int | None = 1000, lr: float = 1e-3,
              weight_decay: float = HEAD_DECAY, seed: int = SPLIT_SEED, age_classes: int = AGE_CLASSES,
              model_dir: str | None = None, save_every: int = SAVE_EVERY, resume: bool = True,
              log_dir: str | None = None, run: str = "train") -> tuple[TwoHeadModel, DataFrame]:
    """Synchronous data-parallel Adam over shuffled batches, up to ``steps`` (None: all full batches); returns
    the model and its trace (``step, name, value, ts``).

    A batch that one task works through sooner than tasks exchange their sums is not shared: each task holds a stretch of
    batches, and the model goes from stretch to stretch, a job for each. So a step costs its work alone, and the jobs are as
    many as the tasks, whatever the number of steps. Larger batches are shared: all steps up to the next checkpoint are one
    Spark job, a barrier stage, where each task keeps its share of the rows, in order of their batches, and the weights; in
    each step it sums the gradient of its rows, the tasks exchange these sums, and all take the same step. These tasks are
    as many as run at once, or fewer if their sums are large (``EXCHANGE_BYTES``). If a task is lost Spark runs its stage
    again, which gives the same weights. With dynamic allocation, which cannot run barrier stages, each step of large batches
    is a job of its own.

    Only keys are put in order; the features move by key once, whatever the number of epochs, and where batches are not shared
    once more to their stretch. Shared batches are spread over all tasks, so ``batch_size`` can grow with the cluster. The
    heads' weights decay by a fixed rate. With
    ``model_dir`` a checkpoint is saved every ``save_every`` steps and at the end, and a later call goes on from the newest one
    at the batch it stopped before, as if there had been no stop. With ``log_dir`` the trace so far is appended there, as
    ``run``, at each checkpoint, so a run that is killed keeps it.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x"),
                     F.col(age).cast("long").alias("age"), F.col(gender).cast("long").alias("gender"))
    if not rows.groupBy("key").count().filter("count > 1").isEmpty():
        raise ValueError("the key must be unique; features_table gives rows one")
    saved = latest_checkpoint(spark, model_dir) if model_dir and resume else None
    found = rows.agg(F.max(F.size("x")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    if saved:
        model = load_model(spark, saved)
    else:
        model = initial_model(found["width"], seed, age_classes) if found["width"] else None
    order = training_batches(rows.select("key"), "key", epochs, batch_size, steps, seed).select("key", "pos", "batch_id")
    slots = spark.sparkContext.defaultParallelism
    alone = model is not None and _alone(batch_size, model)
    barrier = spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() != "true" and not alone
    if barrier and model is not None:
        tasks = _tasks(slots, model)
        rows, order = rows.repartition(tasks, "key"), order.repartition(tasks, "key")
    joined = rows.join(order, "key").select("batch_id", "pos", "x", "age", "gender")
    n_batches = min(found["n"] * epochs // batch_size, math.inf if steps is None else steps)
    stretch = max(1, -(-n_batches // slots))
    if alone:
        joined = joined.repartitionById(slots, F.expr(f"cast(batch_id div {stretch} as int)"))
    batches = (
        joined.sortWithinPartitions("batch_id", "pos").drop("pos")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    last = batches.agg(F.max("batch_id").alias("last")).first()["last"]
    if last is None:
        raise ValueError("no full batch to train on")
    partitions = batches.rdd.getNumPartitions()
    barrier = barrier and partitions <= slots

    trace: list[tuple] = []
    while model.step <= last:
        # Up to the next step after which a checkpoint is saved.
        upto = min(last, -(-model.step // save_every) * save_every) if model_dir else last
        if alone:
            new = []
            while model.step <= upto:
                made, model = _train_job(batches, model, min(upto, (model.step // stretch + 1) * stretch - 1), lr, False)
                new += made
        elif barrier:
            new, model = _train_job(batches, model, upto, lr, True)
        else:
            new = []
            for step in range(model.step, upto + 1):
                sums = _batch_sums(batches.filter(F.col("batch_id") == step), model, partitions)
                rate = _rate(lr, step)
                values, model = _update(model, sums, rate)
                new += [(step, name, float(v), time.time()) for name, v in zip(TRACE, values)]
        trace += new
        if model_dir:
            save_model(spark, model, model_dir)
        if log_dir:
            log_metrics(_trace(spark, new).withColumn("run", F.lit(run)), log_dir)
    if model_dir and not trace:
        save_model(spark, model, model_dir)
    batches.unpersist()
    return model, _trace(spark, trace)


def _trace(spark, rows: list[tuple]) -> DataFrame:
    made = spark.createDataFrame(rows, "step long, name string, value double, seconds double")
    return made.select("step", "name", "value", F.timestamp_seconds("seconds").alias("ts"))


def _rate(lr: float, step: int) -> float:
    return lr * DECAY_RATE ** (step // DECAY_STEPS)


def _tasks(slots: int, model: TwoHeadModel) -> int:
    """Tasks of a barrier stage: each sends its sums, as text, to all."""
    message = 8 * (5 + model.age.size + model.gender.size) * 4 // 3
    return max(1, min(slots, int((EXCHANGE_BYTES / message) ** 0.5)))


def _alone(batch_size: int, model: TwoHeadModel) -> bool:
    """Whether one task is done with a batch before it would hear of the others: scores and gradients take as much work."""
    return 2 * batch_size * (model.age.size + model.gender.size) < EXCHANGE_SECONDS * WORK_A_SECOND


def _train_job(batches: DataFrame, model: TwoHeadModel, last: int, lr: float, shared: bool) -> tuple[list[tuple], TwoHeadModel]:
    """All steps from the model's to ``last``: shared by the tasks of a barrier stage, or by the one task that has all their rows."""
    first, size = model.step, 5 + model.age.size + model.gender.size

    def run(parts):
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get() if shared else None
        mine, now, trace = _by_batch(parts), model, []
        held = next(mine, None)
        if held is None and not shared:
            return
        for step in range(first, last + 1):
            total = np.zeros(size)
            if held is not None and held[0] == step:
                total = _sums(now, *held[1:])
                held = next(mine, None)
            if shared:
                sent = context.allGather(base64.b64encode(total.tobytes()).decode())
                total = np.zeros(size)
                for message in sent:  # in the order of the tasks, so that all have the same sums to the last bit
                    total += np.frombuffer(base64.b64decode(message))
            values, now = _update(now, total, _rate(lr, step))
            trace += [(step, name, float(v), time.time()) for name, v in zip(TRACE, values)]
        if not shared or context.partitionId() == 0:
            out = io.BytesIO()
            np.savez(out, age=now.age, gender=now.gender, **{
                f"m{i}{k}": m for i, moment in enumerate(now.moments) for k, m in enumerate(moment)})
            trace.append((now.step, None, None, None))
            columns = list(zip(*trace))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.float64()))),
                 pa.array([None] * (len(trace) - 1) + [out.getvalue()], pa.binary())],
                names=["step", "name", "value", "seconds", "model"])

    rows = batches.where(F.col("batch_id").between(first, last)).mapInArrow(
        run, "step long, name string, value double, seconds double, model binary", barrier=shared).collect()
    (held,) = (r["model"] for r in rows if r["model"] is not None)
    found = np.load(io.BytesIO(bytes(held)))
    moments = tuple([found[f"m{i}{k}"] for k in range(2)] for i in range(2))
    trace = [(r["step"], r["name"], r["value"], r["seconds"]) for r in rows if r["model"] is None]
    return trace, TwoHeadModel(found["age"], found["gender"], step=last + 1, moments=moments)


def _by_batch(parts) -> Iterator[tuple]:
    """(batch, features, ages, genders) of rows that come in order of their batches."""
    held, now = [], None
    for part in parts:
        if not part.num_rows:
            continue
        ids = part.column("batch_id").to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if ids[a] != now and held:
                yield now, *(np.concatenate(c) for c in zip(*held))
                held = []
            now = int(ids[a])
            rows = part.slice(a, b - a)
            held.append((matrix(rows.column("x")), rows.column("age").to_numpy(), rows.column("gender").to_numpy()))
    if held:
        yield now, *(np.concatenate(c) for c in zip(*held))


def gradient_norm(df: DataFrame, model: TwoHeadModel, features: str = "features", age: str = "age", gender: str = "gender",
                  decay: float = HEAD_DECAY) -> float:
    """Length of the gradient of the mean loss over all rows, with the weights' penalty."""
    ship(df.sparkSession)
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(age).cast("long").alias("age"),
                     F.col(gender).cast("long").alias("gender"))
    sums = _batch_sums(rows, model, rows.rdd.getNumPartitions())
    total, cut = 0.0, 5 + model.age.size
    for w, g in ((model.age, sums[5:cut]), (model.gender, sums[cut:])):
        g = g.reshape(w.shape) / sums[0]
        g[:, :-1] += decay * w[:, :-1]
        total += float(np.square(g).sum())
    return total ** 0.5


def _batch_sums(rows: DataFrame, model: TwoHeadModel, partitions: int) -> np.ndarray:
    """Sums over one batch: row count, both losses, age error, gender hits, then both gradients, flattened."""
    weights = TwoHeadModel(model.age, model.gender)

    def partial(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = _sums(weights, matrix(batch.column("x")), batch.column("age").to_numpy(),
                             batch.column("gender").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total]}, schema=pa.schema([("sums", pa.list_(pa.float64()))]))

    def combine(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = matrix(batch.column("sums")).sum(axis=0)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total]}, schema=pa.schema([("sums", pa.list_(pa.float64()))]))

    sums = rows.select("x", "age", "gender").mapInArrow(partial, "sums array<double>")
    sums = sums.repartition(n_partials(partitions)).mapInArrow(combine, "sums array<double>")
    return matrix(sums.toArrow().column("sums").combine_chunks()).sum(axis=0)


def _sums(model: TwoHeadModel, x: np.ndarray, age: np.ndarray, gender: np.ndarray) -> np.ndarray:
    values, probs = measures(model.logits(x), age, gender)
    inputs = np.column_stack([x, np.ones(len(x))])
    gradients = []
    for p, label in zip(probs, (age, gender)):
        p[np.arange(len(x)), label] -= 1
        gradients.append((p.T @ inputs).ravel())
    totals = [values[n].sum() for n in ("age_xent", "gender_xent", "age_error", "gender_hit")]
    return np.concatenate([[len(x), *totals], *gradients])


def _update(model: TwoHeadModel, sums: np.ndarray, rate: float, decay: float = HEAD_DECAY):
    """One optimizer step from a batch's sums; also the step's trace values, taken before the update."""
    n, age_loss, gender_loss, error, hits = sums[:5]
    weights = [model.age, model.gender]
    cut = 5 + model.age.size
    grads = [sums[5:cut].reshape(model.age.shape) / n, sums[cut:].reshape(model.gender.shape) / n]
    penalty = 0.0
    for w, g in zip(weights, grads):
        penalty += decay * float(np.square(w[:, :-1]).sum()) / 2
        g[:, :-1] += decay * w[:, :-1]
    first, second = model.moments or ([np.zeros_like(w) for w in weights],) * 2
    t = model.step + 1
    first = [BETA1 * m + (1 - BETA1) * g for m, g in zip(first, grads)]
    second = [BETA2 * v + (1 - BETA2) * g * g for v, g in zip(second, grads)]
    scale = rate * np.sqrt(1 - BETA2**t) / (1 - BETA1**t)
    moved = [w - scale * m / (np.sqrt(v) + EPSILON) for w, m, v in zip(weights, first, second)]
    values = (age_loss / n, gender_loss / n, (age_loss + gender_loss) / n + penalty, error / n, hits / n, rate)
    return values, TwoHeadModel(*moved, step=t, moments=(first, second))
