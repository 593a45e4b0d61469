"""Metadata preparation: rows from parallel arrays, corpora, age, quality gates, counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from facetide.functions import age_at
from facetide.functions._util import as_column
from facetide.session import checkpointed

# Fixed values of the quality gates.
MIN_SCORE = 0.75
MIN_AGE, MAX_AGE = 0, 100


def explode_parallel(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per index of equally long array columns; other columns are repeated.

    Unequal lengths are an error, not null padding.
    """
    sizes = [F.size(c) for c in cols]
    same = reduce(lambda a, b: a & b, (s == sizes[0] for s in sizes[1:]), F.lit(True))
    zipped = F.when(same, F.arrays_zip(*cols)).otherwise(
        F.raise_error(F.lit("parallel arrays differ in length: " + ", ".join(cols)))
    )
    others = [c for c in df.columns if c not in cols]
    return df.select(*others, F.inline(zipped).alias(*cols))


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Bag union by column name, in the given order."""
    return reduce(lambda a, b: a.unionByName(b), corpora)


def with_age(meta: DataFrame) -> DataFrame:
    """Metadata columns as later steps want them: dates become an age, scores get their short names."""
    return meta.select(
        *(c for c in meta.columns if c not in ("dob", "photo_taken", "face_score", "second_face_score", "age")),
        age_at("photo_taken", "dob").alias("age"),
        F.col("face_score").alias("score"),
        F.col("second_face_score").alias("second_score"),
    )


def score_ok(score: Column | str = "score", minimum: float = MIN_SCORE) -> Column:
    """Not below the minimum: NaN passes, -Infinity does not.

    NaN is asked for by name. A bare comparison would be pushed to the file scan, and writers other than Spark leave
    NaN out of the minimum and maximum by which row groups are skipped.
    """
    col = as_column(score)
    return F.isnan(col) | ~(col < minimum)


def age_ok(age: Column | str = "age", low: int = MIN_AGE, high: int = MAX_AGE) -> Column:
    return as_column(age).between(low, high)


def label_present(label: Column | str) -> Column:
    """Neither null nor NaN."""
    col = as_column(label)
    return col.isNotNull() & ~F.isnan(col)


def second_face_ok(second_score: Column | str = "second_score") -> Column:
    """No second face: the score is missing (NaN or null) or not above zero."""
    col = as_column(second_score)
    return col.isNull() | F.isnan(col) | ~(col > 0)


def one_detection(n_detections: Column | str) -> Column:
    return as_column(n_detections) == 1


def _gates(second_face: bool, n_detections: str | None) -> list[tuple[str, Column]]:
    gates = [("score", score_ok())]
    if second_face:
        gates.append(("second_face", second_face_ok()))
    gates += [("age", age_ok()), ("gender", label_present("gender"))]
    if n_detections:
        gates.append(("detection", one_detection(n_detections)))
    return gates


def reject_reason(second_face: bool = False, n_detections: str | None = None) -> Column:
    """Name of the first gate a row fails, null for a row to keep. A gate that is unknown has failed."""
    reason = F.when(F.lit(False), F.lit(""))
    for name, passes in _gates(second_face, n_detections):
        reason = reason.when(~F.coalesce(passes, F.lit(False)), F.lit(name))
    return reason


def clean(df: DataFrame, second_face: bool = False, n_detections: str | None = None) -> DataFrame:
    """Rows that pass all gates, as plain conjuncts: those on stored integers and nulls reach the file scan."""
    for _, passes in _gates(second_face, n_detections):
        df = df.filter(passes)
    return df


def exactly_one(df: DataFrame, detections: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key has exactly one row in ``detections``.

    The keys are written out first: a join can only split a hot key of ``df`` at run time if neither side's shuffle
    serves an aggregate as well.
    """
    single = detections.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(key)
    return df.join(checkpointed(single), key, "left_semi")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """A null in one of the columns is an error."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"missing {c}")).cast(df.schema[c].dataType)) for c in columns}
    )


def to_example(df: DataFrame, *extra: str) -> DataFrame:
    """Record fields: 64-bit labels, and those of image bytes and file name that are there."""
    fields = [F.col("age").cast("long").alias("age"), F.col("gender").cast("long").alias("gender")]
    fields += [F.col(c) for c in ("image_raw", "file_name") if c in df.columns]
    return df.select(*extra, *fields)


def prep_report(df: DataFrame, by: Sequence[str], missing: Column | str = "missing") -> DataFrame:
    """Per group: images not found, and valid rows. Partial sums before the shuffle, so hot groups are fine."""
    gone = as_column(missing)
    return df.groupBy(*by).agg(
        F.count_if(gone).alias("missing"),
        F.count_if(~gone).alias("valid"),
    )
