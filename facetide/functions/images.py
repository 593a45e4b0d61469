"""Raw image bytes to numbers, in Arrow batches: Spark has no built-in that reads bytes as an array."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from facetide.functions._util import as_column
from facetide.session import ship

# Fixed shape of an aligned face image: height, width, channels.
IMAGE_SHAPE = (160, 160, 3)


def _checked(col: Column | str, size: int) -> Column:
    data = as_column(col)
    return F.when(data.isNull() | (F.octet_length(data) == size), data).otherwise(
        F.raise_error(F.format_string(f"image has %d bytes, not {size}", F.octet_length(data))).cast("binary")
    )


def decode_raw(col: Column | str, shape: Sequence[int] = IMAGE_SHAPE) -> Column:
    """Bytes as unsigned 8-bit values, row-major; a wrong length is an error, null stays null."""
    return _pixels(_checked(col, math.prod(shape)), shape, reverse=False)


def image_tensor(col: Column | str, shape: Sequence[int] = IMAGE_SHAPE) -> Column:
    """Model input from raw bytes: channels reversed, then standardized per image, as floats."""
    return _pixels(_checked(col, math.prod(shape)), shape, reverse=True)


def image_features(col: Column | str, make_features: Callable, shape: Sequence[int] = IMAGE_SHAPE,
                   batch_size: int = 64) -> Column:
    """Feature vectors from raw image bytes, by a user's network.

    ``make_features`` is called once per task and returns a function from a float32 batch ``(n, height, width,
    channels)`` to a matrix ``(n, features)``. Bytes go in and vectors come out: the tensors, four times the size of the
    bytes, stay in the Python worker.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = make_features()
        for data in batches:
            raw = _bytes_matrix(data, math.prod(shape))
            parts = [
                np.asarray(features(_tensors(raw[at:at + batch_size], shape[-1]).reshape(-1, *shape)), np.float32)
                for at in range(0, len(raw), batch_size)
            ]
            yield _lists(data, np.concatenate(parts) if parts else np.empty((0, 0), np.float32))

    ship(SparkSession.active())
    return F.arrow_udf(run, "array<float>")(_checked(col, math.prod(shape)))


def _pixels(col: Column, shape: Sequence[int], reverse: bool) -> Column:
    def batch(data: pa.Array) -> pa.Array:
        raw = _bytes_matrix(data, math.prod(shape))
        return _lists(data, _tensors(raw, shape[-1]) if reverse else raw.astype("int16"))

    ship(SparkSession.active())
    return F.arrow_udf(batch, "array<float>" if reverse else "array<smallint>")(col)


def _bytes_matrix(data: pa.Array, size: int) -> np.ndarray:
    whole = data.drop_null()
    return np.frombuffer(b"".join(whole.to_pylist()), dtype=np.uint8).reshape(len(whole), size)


def _tensors(raw: np.ndarray, channels: int) -> np.ndarray:
    n, size = raw.shape
    values = raw.reshape(n, size // channels, channels)[:, :, ::-1].reshape(n, size).astype(np.float32)
    values -= values.mean(axis=1, keepdims=True, dtype=np.float64).astype(np.float32)
    # The values are centred now, so their mean square is the variance.
    std = np.sqrt(np.einsum("ij,ij->i", values, values, dtype=np.float64) / size)[:, None]
    values /= np.maximum(std, 1.0 / np.sqrt(size)).astype(np.float32)
    return values


def _lists(data: pa.Array, values: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column, with the nulls of ``data`` put back in."""
    # A null row takes no elements, so its list starts and ends at the same offset.
    present = data.is_valid().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(present, dtype=np.int64) * values.shape[1]])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(values.ravel()), mask=None if present.all() else pa.array(~present)
    )
