"""Serial birth dates and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from facetide.functions._util import as_column

# Fixed values of the serial date format: day 367 is 0001-01-01; later than 9999-12-31 is no date.
SERIAL_OFFSET = 366
LAST_ORDINAL = 3652059
# Photos are taken in mid-year: a birthday before this month has already passed.
MID_YEAR_MONTH = 7


def safe_int(col: Column | str) -> Column:
    """Truncating integer cast; NaN, infinities and overflow give null instead of an error."""
    return as_column(col).try_cast("int")


def serial_to_date(col: Column | str) -> Column:
    """Serial day number to date. Day numbers before year 1 clamp to 0001-01-01."""
    days = safe_int(col)
    ordinal = F.greatest(days - SERIAL_OFFSET, F.lit(1))
    return F.when(
        days.between(-(2**31) + SERIAL_OFFSET, LAST_ORDINAL + SERIAL_OFFSET),
        F.date_add(F.lit("0001-01-01").cast("date"), ordinal - 1),
    )


def age_at(taken: Column | str, dob: Column | str) -> Column:
    """Age in the year ``taken`` of someone born on serial day ``dob``; may be negative or above 100."""
    birth = serial_to_date(dob)
    return as_column(taken) - F.year(birth) - F.when(F.month(birth) < MID_YEAR_MONTH, 0).otherwise(1)
