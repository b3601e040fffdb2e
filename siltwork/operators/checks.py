"""Row checks. Each returns the rows, or distinct values, that break a rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions import amounts, codes, dates, text


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def whitespace_violations(
    df: DataFrame, cols: Sequence[str], collation: str | None = None
) -> DataFrame:
    """Values of ``cols`` where at least one has leading or trailing blanks."""
    return df.select(*cols).where(any_of([text.has_stray_blanks(c, collation) for c in cols]))


def domain_values(df: DataFrame, col: str, collation: str | None = None) -> DataFrame:
    """Distinct values of ``col``, NULL included.

    Under a collation equal values are shown once, by their smallest spelling.
    """
    if collation is None:
        return df.select(col).distinct()
    # Bytewise distinct first, by hash; few values are left for the collated step,
    # which sorts. A plain distinct would be taken out as redundant; a filter on the
    # count keeps it.
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 0")
        .groupBy(F.collate(F.col(col), collation).alias("__same"))
        .agg(F.min(col).alias(col))
        .select(col)
    )


def mapping_preview(
    df: DataFrame, col: str, labels: Mapping[str, str], name: str, collation: str | None = None
) -> DataFrame:
    """Each distinct raw value beside the label it would get.

    Distinct first: the label is computed once per value, not once per row.
    Under a collation equal values are shown once.
    """
    return domain_values(df, col, collation).withColumn(name, codes.map_codes(col, labels))


def invalid_int_dates(
    df: DataFrame,
    cols: Sequence[str],
    bounded: Sequence[str] = (),
    low: int = dates.EARLIEST_ORDER,
    high: int = dates.LATEST_ORDER,
) -> DataFrame:
    """Rows with a date that is NULL or not eight characters, or outside the bounds.

    Bounds are exclusive and apply to the ``bounded`` columns only. Whether the
    digits are a calendar date is not tested.
    """
    return df.where(invalid_int_date(cols, bounded, low, high))


def invalid_int_date(
    cols: Sequence[str],
    bounded: Sequence[str] = (),
    low: int = dates.EARLIEST_ORDER,
    high: int = dates.LATEST_ORDER,
) -> Column:
    plausible = [dates.eight_characters(c) for c in cols] + [
        F.coalesce(F.col(c).between(low, high), F.lit(True)) for c in bounded
    ]
    return amounts.not_true(reduce(and_, plausible))


def date_order_violations(df: DataFrame, first: str, later: Sequence[str]) -> DataFrame:
    """Rows where ``first`` comes after one of ``later``; NULLs are never flagged."""
    return df.where(date_order_violated(first, later))


def date_order_violated(first: str, later: Sequence[str]) -> Column:
    return any_of([F.col(first) > F.col(c) for c in later])


def date_out_of_range(
    df: DataFrame, col: str, as_of: dt.date, low: dt.date = dates.EARLIEST_BIRTH
) -> DataFrame:
    """Distinct dates before ``low`` or after ``as_of``."""
    return df.select(col).where(dates.outside(col, low, as_of)).distinct()


def amount_violations(
    df: DataFrame, sales: str, quantity: str, price: str
) -> DataFrame:
    """Rows where an amount is missing or not positive, or sales is inconsistent."""
    return df.where(amounts.inconsistent(amounts.raw_amounts(df, sales, quantity, price)))


def distinct_amount_violations(
    df: DataFrame, sales: str, quantity: str, price: str
) -> DataFrame:
    """Distinct violating amounts, sorted; NULLs come first."""
    cols = (sales, quantity, price)
    return amount_violations(df.select(*cols), *cols).distinct().orderBy(*cols)


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: the row count and how often each rule is broken, in a single scan."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(broken).alias(name) for name, broken in rules.items()],
    )
