"""Amount repair under a chosen policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions import amounts
from siltwork.operators.ordering import ordered

# policy -> (repair, rows it looks at)
POLICIES = {
    "recompute": (amounts.recompute, amounts.inconsistent),
    "trust_qty_price": (amounts.trust_inputs, None),
    "business": (amounts.business, amounts.any_missing),
}


def repair_amounts(
    df: DataFrame,
    policy: str,
    sales: str,
    quantity: str,
    price: str,
    keep: Sequence[str] = (),
    faulty_only: bool = True,
    sort: bool = True,
) -> DataFrame:
    """Repaired amounts beside the raw ones (``old_sales``, ``old_qty``, ``old_price``).

    ``faulty_only`` shows the rows the policy is meant for, sorted by the
    repaired amounts; ``trust_qty_price`` is meant for all rows and unsorted.
    Columns in ``keep`` come first, unchanged.
    """
    repair, applies_to = POLICIES[policy]
    raw = amounts.raw_amounts(df, sales, quantity, price)
    fixed = repair(raw)
    rows = df.where(applies_to(raw)) if faulty_only and applies_to else df
    result = rows.select(
        *keep,
        F.col(sales).alias("old_sales"),
        F.col(quantity).alias("old_qty"),
        F.col(price).alias("old_price"),
        fixed.sales.alias(sales),
        fixed.quantity.alias(quantity),
        fixed.price.alias(price),
    )
    return ordered(result, [sales, quantity, price]) if sort and applies_to else result
