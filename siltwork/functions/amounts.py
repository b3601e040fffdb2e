"""Sales = quantity x price: the consistency test and three repair policies.

All expressions read the raw columns, so the three repaired columns must be
selected together and never one after another. Integers are widened to bigint
first: a product of two ints always fits and one overflowing row cannot stop a
job over billions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Amounts(NamedTuple):
    sales: Column
    quantity: Column
    price: Column
    whole: bool = True  # all three are integers, so division drops the fraction


def raw_amounts(df: DataFrame, sales: str, quantity: str, price: str) -> Amounts:
    """The three columns of ``df``, integers as bigint."""
    kinds = [df.schema[name].dataType for name in (sales, quantity, price)]
    columns = [
        F.col(name).cast("bigint") if isinstance(kind, T.IntegralType) else F.col(name)
        for name, kind in zip((sales, quantity, price), kinds)
    ]
    return Amounts(*columns, whole=all(isinstance(kind, T.IntegralType) for kind in kinds))


def not_true(condition: Column) -> Column:
    """True where ``condition`` is false or NULL.

    Rules are written as "not known to be right": one mention of each column is
    enough, where listing every way to be wrong needs several.
    """
    return ~F.coalesce(condition, F.lit(False))


def _all_positive(raw: Amounts) -> Column:
    return (raw.sales > 0) & (raw.quantity > 0) & (raw.price > 0)


def any_missing(raw: Amounts) -> Column:
    """Some amount is NULL, zero or negative."""
    return not_true(_all_positive(raw))


def inconsistent(raw: Amounts) -> Column:
    """Some amount is missing, or sales is not quantity x price."""
    return not_true(_all_positive(raw) & (raw.sales == raw.quantity * raw.price))


def _quotient(raw: Amounts, over: Column, under: Column) -> Column:
    nonzero = F.nullif(under, F.lit(0))
    return F.call_function("div", over, nonzero) if raw.whole else over / nonzero


def recompute(raw: Amounts) -> Amounts:
    """Trust whatever is usable and derive the rest from it.

    Sales becomes |quantity| x |price| wherever that is known and otherwise
    stays if positive. A missing quantity or price is derived from the raw
    sales. The price divides by the signed quantity, so it can come out negative.
    """
    return Amounts(
        F.coalesce(F.abs(raw.quantity * raw.price), F.when(raw.sales > 0, raw.sales)),
        F.when(raw.quantity > 0, raw.quantity).otherwise(
            _quotient(raw, raw.sales, F.abs(raw.price))
        ),
        F.when(raw.price > 0, raw.price).otherwise(_quotient(raw, raw.sales, raw.quantity)),
        raw.whole,
    )


def trust_inputs(raw: Amounts) -> Amounts:
    """Quantity and price are the truth: unusable ones are NULL, sales follows."""
    quantity = F.when(raw.quantity > 0, raw.quantity)
    price = F.when(raw.price > 0, raw.price)
    return Amounts(quantity * price, quantity, price, raw.whole)


def business(raw: Amounts) -> Amounts:
    """The sign of a quantity is noise; sales is derived; only a missing price is."""
    usable = (raw.quantity > 0) & (raw.price > 0)
    derived = F.abs(_quotient(raw, raw.sales, raw.quantity))
    return Amounts(
        F.when(usable, raw.quantity * raw.price),
        F.abs(raw.quantity),
        F.when(raw.price > 0, raw.price).otherwise(derived),
        raw.whole,
    )
