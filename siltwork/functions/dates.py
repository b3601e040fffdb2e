"""Dates held as ``yyyymmdd`` integers, and plausibility ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plausible ranges agreed with the business.
EARLIEST_ORDER = 19990101
LATEST_ORDER = 20300101
EARLIEST_BIRTH = dt.date(1924, 1, 1)


def int_to_date(col: Column | str) -> Column:
    """The integer ``20100228`` as a date; NULL when its digits are no calendar date.

    Built from its parts, which takes a fraction of the time a date pattern does.
    """
    value = F.col(col) if isinstance(col, str) else col

    def without_last(digits: int) -> Column:
        return F.call_function("div", value, F.lit(10**digits)).cast("int")

    midnight = F.try_make_timestamp_ntz(
        without_last(4), without_last(2) % 100, value % 100, F.lit(0), F.lit(0), F.lit(0)
    )
    return F.when(value.between(10000101, 99991231), midnight.cast("date"))


def eight_characters(col: Column | str) -> Column:
    """True when the integer is written with eight characters, a sign included.

    The value is named once: it may be a long expression, which a filter pushed below
    it would spell out, and compute, wherever it is named.
    """
    value = F.col(col) if isinstance(col, str) else col
    return F.length(value.cast("string")) == 8


def outside(col: Column | str, low, high) -> Column:
    """Strictly below ``low`` or strictly above ``high``; NULL for NULL."""
    value = F.col(col) if isinstance(col, str) else col
    return (value < F.lit(low)) | (value > F.lit(high))
