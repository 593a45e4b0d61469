"""Maths on array columns (logits, probabilities, feature vectors), all as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from facetide.functions._util import as_column, let


def _doubles(col: Column | str) -> Column:
    return as_column(col).cast("array<double>")


def _total(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x)


def softmax(col: Column | str) -> Column:
    """Probabilities from logits; the maximum is subtracted first so large logits do not overflow."""
    logits = _doubles(col)
    return let(
        let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top))),
        lambda e: let(_total(e), lambda s: F.transform(e, lambda x: x / s)),
    )


def expected_index(probs: Column | str) -> Column:
    """Sum of ``p[i] * i``: the mean class, a float even for integer classes."""
    return F.aggregate(
        F.transform(_doubles(probs), lambda p, i: p * i), F.lit(0.0), lambda acc, x: acc + x
    )


def argmax(col: Column | str) -> Column:
    """Zero-based index of the first maximum."""
    values = as_column(col)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def in_top_k(logits: Column | str, label: Column | str, k: int = 1) -> Column:
    """Whether fewer than ``k`` logits are strictly above the label's, so ties count as hits.

    A non-finite label logit is a miss; a label outside the array is an error.
    """
    values = _doubles(logits)
    return let(
        values[as_column(label)],
        lambda own: (F.size(F.filter(values, lambda x: x > own)) < k)
        & ~F.isnan(own)
        & (F.abs(own) < F.lit(float("inf"))),
    )


def sparse_xent(logits: Column | str, label: Column | str) -> Column:
    """Softmax cross-entropy against a class index: ``logsumexp(logits) - logits[label]``."""
    values = _doubles(logits)
    log_sum = let(
        F.array_max(values),
        lambda top: top + F.log(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
    )
    return log_sum - values[as_column(label)]


def abs_error(a: Column | str, b: Column | str) -> Column:
    return F.abs(as_column(a) - as_column(b))


def standardize(col: Column | str) -> Column:
    """``(x - mean) / max(population std, 1/sqrt(n))`` over all elements of the row."""
    values = _doubles(col)
    n = F.size(values)

    def scaled(mean: Column) -> Column:
        variance = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n
        floor = F.lit(1.0) / F.sqrt(n)
        return let(
            F.greatest(F.sqrt(variance), floor), lambda std: F.transform(values, lambda x: (x - mean) / std)
        )

    return F.when(n == 0, values).otherwise(let(F.try_divide(_total(values), n), scaled))


def reverse_channels(col: Column | str, channels: int = 3) -> Column:
    """Reverse each run of ``channels`` elements. The length must be a multiple of ``channels``."""
    values = as_column(col)
    swapped = let(values, lambda v: F.transform(v, lambda _, i: v[i - (i % channels) * 2 + (channels - 1)]))
    return F.when(F.size(values) % channels == 0, swapped).otherwise(
        F.raise_error(F.lit(f"array length is not a multiple of {channels}"))
    )


def l2_penalty(weights: Column | str, weight_decay: float | Column) -> Column:
    """``weight_decay * sum(w * w) / 2`` for one weight tensor."""
    decay = weight_decay if isinstance(weight_decay, Column) else F.lit(float(weight_decay))
    return F.aggregate(_doubles(weights), F.lit(0.0), lambda acc, w: acc + w * w) * decay / 2
