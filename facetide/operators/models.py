"""The two-head model (age and gender softmax over one feature vector): weights, checkpoints, scoring."""

from __future__ import annotations

import math
import os
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from facetide.operators.metrics import HEAD_DECAY
from facetide.session import ship

# Fixed sizes of the heads: ages 0 to 100, two genders.
AGE_CLASSES, GENDER_CLASSES = 101, 2
HEADS = ("age", "gender")
KEEP_CHECKPOINTS = 100
# Models scored together in one pass are sent to each executor: at most this many bytes, then another pass.
MAX_MODEL_BYTES = 256 << 20

WEIGHT_SCHEMA = "head string, class int, weights array<double>, first array<double>, second array<double>"


@dataclass(frozen=True)
class TwoHeadModel:
    """Weights per head, one row per class, the bias in the last column; with optimizer moments while training."""

    age: np.ndarray
    gender: np.ndarray
    step: int = 0
    moments: tuple | None = None

    def logits(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(features @ w[:, :-1].T + w[:, -1] for w in (self.age, self.gender))

    @property
    def penalty(self) -> float:
        """L2 penalty of both heads' weights; biases are free."""
        return sum(HEAD_DECAY * float(np.square(w[:, :-1]).sum()) / 2 for w in (self.age, self.gender))

    @property
    def nbytes(self) -> int:
        return self.age.nbytes + self.gender.nbytes


# --- checkpoints ------------------------------------------------------------------------------------------------


def save_model(spark: SparkSession, model: TwoHeadModel, directory: str, keep: int = KEEP_CHECKPOINTS) -> str:
    """Save under ``<directory>/save=<k>-step=<n>`` and drop all but the ``keep`` saved last.

    Saves are counted, so the latest checkpoint is the one saved last, whatever its step. Saving the step of the latest one
    again replaces it. The weights are written aside and get their name when they are whole. The number is claimed by
    creating a file that must not exist yet, so two writers never take the same one.
    """
    from facetide.sources.files import qualified, resolve

    if keep < 1:
        raise ValueError("keep at least the checkpoint that is being saved")
    directory = qualified(spark, directory).rstrip("/")
    zero = [np.zeros_like(model.age), np.zeros_like(model.gender)]
    first, second = model.moments or (zero, zero)
    rows = [
        (head, k, w[k].tolist(), m[k].tolist(), v[k].tolist())
        for head, w, m, v in zip(HEADS, (model.age, model.gender), first, second)
        for k in range(len(w))
    ]
    aside = f"{directory}/_saving-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, WEIGHT_SCHEMA).coalesce(1).write.parquet(aside)
    system, source = resolve(aside)
    saved = checkpoints(spark, directory)
    if saved and _step(saved[-1]) == model.step:
        path = saved[-1]
        _delete(path)
    else:
        number = _save(saved[-1]) + 1 if saved else 1
        while not _claimed(spark, directory, number):
            number += 1
        path = f"{directory}/save={number:06d}-step={model.step:09d}"
    system.move(source, resolve(path)[1])
    for old in checkpoints(spark, directory)[:-keep]:
        _delete(old)
    return path


def _claimed(spark: SparkSession, directory: str, number: int) -> bool:
    """Create the file that stands for a save number; false if there is one already."""
    if directory.startswith("file:"):  # where Hadoop asks and then creates, which two writers can do at once
        from facetide.sources.files import resolve

        claims = resolve(f"{directory}/_claims")[1]
        os.makedirs(claims, exist_ok=True)
        try:
            os.close(os.open(f"{claims}/{number:06d}", os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o666))
        except FileExistsError:
            return False
        return True
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{directory}/_claims/{number:06d}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(place)


def _delete(path: str) -> None:
    """Remove a checkpoint, which another writer may have done already."""
    from facetide.sources.files import resolve

    system, inner = resolve(path)
    try:
        system.delete_dir(inner)
    except FileNotFoundError:
        pass


def load_models(spark: SparkSession, paths: Sequence[str]) -> list[TwoHeadModel]:
    """The weights of several checkpoints, without the optimizer's moments, in one job."""
    rows = spark.read.schema(WEIGHT_SCHEMA).parquet(*paths).select(
        "head", "class", "weights", F.col("_metadata.file_path").alias("file")).collect()
    held: dict[str, dict[str, list]] = {}
    for r in sorted(rows, key=lambda r: r["class"]):
        held.setdefault(r["file"].rsplit("/", 2)[1], {h: [] for h in HEADS})[r["head"]].append(r["weights"])
    found = (held[path.rstrip("/").rsplit("/", 1)[1]] for path in paths)
    return [TwoHeadModel(*(np.array(f[h]) for h in HEADS), step=_step(p)) for p, f in zip(paths, found)]


def load_model(spark: SparkSession, path: str) -> TwoHeadModel:
    """Load one checkpoint: a row per class, whatever the data size."""
    rows = sorted(spark.read.schema(WEIGHT_SCHEMA).parquet(path).collect(), key=lambda r: r["class"])
    stacked = {
        field: [np.array([r[field] for r in rows if r["head"] == head]) for head in HEADS]
        for field in ("weights", "first", "second")
    }
    return TwoHeadModel(
        *stacked["weights"], step=_step(path), moments=(stacked["first"], stacked["second"])
    )


def _step(path: str) -> int:
    return int(path.rstrip("/").rsplit("step=", 1)[1])


def _save(path: str) -> int:
    return int(path.rstrip("/").rsplit("save=", 1)[1].split("-", 1)[0])


def checkpoints(spark: SparkSession, directory: str) -> list[str]:
    """Checkpoint paths of a run, in the order in which they were saved."""
    from pyarrow import fs

    from facetide.sources.files import qualified, resolve

    directory = qualified(spark, directory)
    system, root = resolve(directory)
    found = system.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True))
    names = [i.base_name for i in found if i.type == fs.FileType.Directory and re.fullmatch(r"save=\d+-step=\d+", i.base_name)]
    return [f"{directory.rstrip('/')}/{n}" for n in sorted(names, key=_save)]


def latest_checkpoint(spark: SparkSession, directory: str) -> str | None:
    return (checkpoints(spark, directory) or [None])[-1]


def registry_table(spark: SparkSession, directory: str, run: str) -> DataFrame:
    """Registry rows ``(run, idx, step, path)`` of a run's checkpoints."""
    rows = [(run, i, _step(p), p) for i, p in enumerate(checkpoints(spark, directory))]
    return spark.createDataFrame(rows, "run string, idx int, step long, path string")


def weights_table(spark: SparkSession, path: str) -> DataFrame:
    """Weight tensors of a checkpoint without biases, one row per class: input to the L2 penalty."""
    rows = spark.read.schema(WEIGHT_SCHEMA).parquet(path)
    return rows.select("head", "class", F.slice("weights", 1, F.size("weights") - 1).alias("weights"))


# --- scoring ----------------------------------------------------------------------------------------------------


def softmax_rows(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and the log of the sum of exponentials, row by row."""
    top = logits.max(axis=1, keepdims=True)
    e = np.exp(logits - top)
    total = e.sum(axis=1, keepdims=True)
    return e / total, np.log(total[:, 0]) + top[:, 0]


def measures(logits, age: np.ndarray, gender: np.ndarray) -> tuple[dict[str, np.ndarray], list[np.ndarray]]:
    """Per row what the metrics need, and both heads' probabilities."""
    n = np.arange(len(age))
    probs, xents, own = [], [], []
    for z, label in zip(logits, (age, gender)):
        if len(label) and (label.min() < 0 or label.max() >= z.shape[1]):
            raise ValueError(f"label outside 0..{z.shape[1] - 1}")
        p, log_sum = softmax_rows(z)
        probs.append(p)
        own.append(z[n, label])
        xents.append(log_sum - own[-1])
    pred_age = probs[0] @ np.arange(probs[0].shape[1])
    return {
        "age_xent": xents[0],
        "gender_xent": xents[1],
        "pred_age": pred_age,
        "pred_gender": logits[1].argmax(axis=1).astype(np.int32),
        "gender_hit": ((logits[1] > own[1][:, None]).sum(axis=1) < 1) & np.isfinite(own[1]),
        "age_error": np.abs(pred_age - age),
    }, probs


MODEL_FIELDS = [StructField("idx", IntegerType()), StructField("path", StringType()), StructField("penalty", DoubleType())]
LOGIT_FIELDS = [StructField(f"{head}_logits", ArrayType(DoubleType())) for head in HEADS]
PREDICT_FIELDS = [StructField("pred_gender", IntegerType()), StructField("pred_age", DoubleType())]
MEASURE_FIELDS = [
    *(StructField(n, DoubleType()) for n in ("age_xent", "gender_xent", "pred_age")),
    StructField("pred_gender", IntegerType()), StructField("gender_hit", BooleanType()),
    StructField("age_error", DoubleType()),
]


def score_models(df: DataFrame, models: Sequence[tuple[str, TwoHeadModel]], features: str = "features") -> DataFrame:
    """Logits of every model for every row, in one pass over the data.

    Adds ``idx, path, penalty, age_logits, gender_logits`` and drops the features. Matrix products run on whole Arrow
    batches; the models travel as one broadcast of checked size per pass.
    """
    return _each_model(df, models, features, LOGIT_FIELDS, lambda batch, logits: [as_lists(z) for z in logits])


def measure_models(df: DataFrame, models: Sequence[tuple[str, TwoHeadModel]], features: str = "features") -> DataFrame:
    """Like ``score_models``, with losses, predictions and errors in place of the logits.

    For rows with ``age_label`` and ``gender_label``. Six numbers per row and model leave the Python worker, not the
    logits of all classes.
    """
    def columns(batch, logits):
        import pyarrow as pa

        age, gender = (batch.column(f"{head}_label").to_numpy(zero_copy_only=False) for head in HEADS)
        values, _ = measures(logits, age, gender)
        return [pa.array(values[f.name]) for f in MEASURE_FIELDS]

    return _each_model(df, models, features, MEASURE_FIELDS, columns)


def measure_rows(df: DataFrame, models: Sequence[tuple[str, TwoHeadModel]], features: str = "features") -> DataFrame:
    """Replace the features by ``measures``, an array with a struct (idx and what ``measure_models`` adds) per model.

    The data are read once: where the models are too many for one broadcast, further passes are maps over the same rows.
    """
    ship(df.sparkSession)
    groups, size = [[]], 0
    for idx, (_, model) in enumerate(models):
        if groups[-1] and size + model.nbytes > MAX_MODEL_BYTES:
            groups.append([])
            size = 0
        size += model.nbytes
        groups[-1].append((idx, TwoHeadModel(model.age, model.gender)))
    one = ArrayType(StructType([StructField("idx", IntegerType()), *MEASURE_FIELDS]))
    for i, group in enumerate(groups):
        schema = StructType([*df.schema.fields, StructField(f"_measures{i}", one)])
        df = df.mapInArrow(_measurer(df.sparkSession.sparkContext.broadcast(group), schema, features), schema)
    made = [f"_measures{i}" for i in range(len(groups))]
    return df.select("*", F.concat(*made).alias("measures")).drop(features, *made)


def _measurer(models, schema: StructType, features: str) -> Callable:
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        kind = arrow.field(len(arrow) - 1).type
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column(batch.schema.get_field_index(features)))
            age, gender = (batch.column(batch.schema.get_field_index(f"{head}_label")).to_numpy(zero_copy_only=False)
                           for head in HEADS)
            columns = [[] for _ in range(1 + len(MEASURE_FIELDS))]
            for idx, model in models.value:
                values, _ = measures(model.logits(x), age, gender)
                for held, column in zip(columns, (np.full(n, idx, np.int32), *(values[f.name] for f in MEASURE_FIELDS))):
                    held.append(column)
            # Row by row, all models of a row together.
            flat = [pa.array(np.stack(c, axis=1).ravel()).cast(kind.value_type.field(k).type) for k, c in enumerate(columns)]
            structs = pa.StructArray.from_arrays(flat, fields=list(kind.value_type))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(models.value) + 1, len(models.value), dtype=np.int32)), structs)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists.cast(kind)], schema=arrow)

    return run


def _each_model(df: DataFrame, models: Sequence[tuple[str, TwoHeadModel]], features: str, fields: list[StructField],
                columns: Callable) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    kept = [f for f in df.schema.fields if f.name != features]
    schema = StructType([*kept, *MODEL_FIELDS, *fields])
    source = df.select(*(f.name for f in kept), features)
    passes: list[list] = [[]]
    size = 0
    for idx, (path, model) in enumerate(models):
        if passes[-1] and size + model.nbytes > MAX_MODEL_BYTES:
            passes.append([])
            size = 0
        size += model.nbytes
        passes[-1].append((idx, path, model.penalty, TwoHeadModel(model.age, model.gender)))
    parts = [
        source.mapInArrow(_scorer(spark.sparkContext.broadcast(group), schema, columns), schema) for group in passes
    ]
    return reduce(DataFrame.unionByName, parts)


def _scorer(models, schema: StructType, columns: Callable) -> Callable:
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column(batch.num_columns - 1))
            for idx, path, penalty, model in models.value:
                constants = [pa.array([v] * n, t) for v, t in
                             ((idx, pa.int32()), (path, pa.string()), (penalty, pa.float64()))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *constants, *columns(batch, model.logits(x))], schema=arrow
                )

    return run


def matrix(column) -> np.ndarray:
    """A list column as a matrix; rows must be equally long and complete."""
    flat = column.flatten()
    if column.null_count or flat.null_count or len(flat) % max(len(column), 1):
        raise ValueError("feature vectors must be complete and of equal length")
    out = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != out.shape[1]).any():
        raise ValueError("feature vectors must be of equal length")
    return out


def as_lists(values: np.ndarray):
    import pyarrow as pa

    rows, width = values.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def predict(df: DataFrame, model: TwoHeadModel, features: str = "features") -> DataFrame:
    """Add ``pred_gender`` (class) and ``pred_age`` (expected age); ``age`` and ``gender`` pass through, whatever they hold."""
    def columns(batch, logits):
        import pyarrow as pa

        probs, _ = softmax_rows(logits[0])
        return [pa.array(logits[1].argmax(axis=1).astype(np.int32)), pa.array(probs @ np.arange(probs.shape[1]))]

    scored = _each_model(df, [("", model)], features, PREDICT_FIELDS, columns)
    return scored.select(
        *(c for c in df.columns if c not in (features, "age", "gender")),
        F.col("gender").alias("real_gender"),
        F.col("age").alias("real_age"),
        "pred_gender",
        "pred_age",
    )


def score(df: DataFrame, make_predict_fn: Callable, features: str, return_type, batch_size: int = 1024,
          output: str = "prediction", input_tensor_shapes=None) -> DataFrame:
    """Add a column computed by a user model, loaded once per worker by ``make_predict_fn``."""
    from pyspark.ml.functions import predict_batch_udf

    fn = predict_batch_udf(
        make_predict_fn, return_type=return_type, batch_size=batch_size, input_tensor_shapes=input_tensor_shapes
    )
    return df.withColumn(output, fn(features))


def n_partials(partitions: int) -> int:
    """How many tasks combine that many partial sums before the driver adds up the rest."""
    return max(1, math.isqrt(partitions))
