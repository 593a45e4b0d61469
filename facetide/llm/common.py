"""What the operators share: reading, scratch tables, and columns whose names clash."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from facetide.session import scratch_path

#: Words of a text, as the quality, mixing and joining operators count them.
WORD = r"[^\x20\x09-\x0D]+"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
#: A table is broadcast only if it was counted and its bytes are at most this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return read.select(*columns) if columns else read


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the files, so that a lost executor costs no more than a reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns that have the name of a result (case does not count); the result replaces them."""
    taken = {n.lower() for n in names}
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in taken))


def apart(df: DataFrame, results: Iterable[str], columns: Iterable[str], operate: Callable[..., DataFrame]) -> DataFrame:
    """``operate(df, *columns)`` on columns with names of their own, so that none clashes with a working column of the operator.

    Columns with the name of a result are left out, but for those that are worked on; all get their names back.
    """
    lower = {c.lower() for c in columns}
    held = without(df, {r for r in results if r.lower() not in lower})
    names = {c.lower(): f"in{i}" for i, c in enumerate(held.columns)}
    back = dict(zip(names.values(), held.columns))
    inner = held.select(*(F.col(f"`{c}`").alias(names[c.lower()]) for c in held.columns))
    out = operate(inner, *(names[c.lower()] for c in columns))
    return out.select(*(F.col(n).alias(back.get(n, n)) for n in out.columns))


def bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a stored table for broadcast if its counted rows, at ``row_bytes`` each, stay within the bound."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def constants(values: Iterable[float], kind: str) -> Column:
    """A constant array: one literal, whatever its length."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows of the fold on which models are tested: crc32 of the key as text is divisible; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def fenced(df: DataFrame, keep: Iterable[str], made: Iterable[str]) -> DataFrame:
    """Keep a later filter on ``made`` above the work that makes it.

    Pushed below, a filter takes a copy of every expression that it needs, and of those in them. No filter passes a
    generator on whose output it depends; of a single element it costs nothing.
    """
    made = list(made)
    one = F.explode(F.array(F.struct(*(F.col(f"`{c}`") for c in made)))).alias("_made")
    return df.select(*(F.col(f"`{c}`") for c in keep), one).select(
        *(F.col(f"`{c}`") for c in keep), *(F.col(f"_made.`{c}`").alias(c) for c in made))
