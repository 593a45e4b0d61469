from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once per row for use inside ``body``.

    A column captured by a higher-order function's lambda is evaluated again for each element, which makes
    ``transform(l, x -> x - array_max(l))`` quadratic. A lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]
