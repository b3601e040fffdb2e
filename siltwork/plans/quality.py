"""Quality reports: all row rules of a table counted in one scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions import amounts, dates, text
from siltwork.operators.checks import (
    count_violations,
    date_order_violated,
    invalid_int_date,
)


def customer_report(df: DataFrame) -> DataFrame:
    blanks = ("cst_firstname", "cst_lastname", "cst_gndr", "cst_marital_status")
    rules = {"null_cst_id": F.col("cst_id").isNull()}
    rules |= {f"blanks_{c}": text.has_stray_blanks(c) for c in blanks}
    return count_violations(df, rules)


def sales_amount_report(df: DataFrame, sales: str, quantity: str, price: str) -> DataFrame:
    raw = amounts.raw_amounts(df, sales, quantity, price)
    named = {"sales": raw.sales, "quantity": raw.quantity, "price": raw.price}
    rules = {f"null_{n}": c.isNull() for n, c in named.items()}
    rules |= {f"nonpositive_{n}": c <= 0 for n, c in named.items()}
    rules["sales_not_product"] = raw.sales != raw.quantity * raw.price
    rules["any_violation"] = amounts.inconsistent(raw)
    return count_violations(df, rules)


def sales_date_report(df: DataFrame, order: str, ship: str, due: str) -> DataFrame:
    rules = {f"null_{c}": F.col(c).isNull() for c in (order, ship, due)}
    rules |= {f"not_eight_{c}": ~dates.eight_characters(c) for c in (order, ship, due)}
    rules[f"outside_{due}"] = dates.outside(due, dates.EARLIEST_ORDER, dates.LATEST_ORDER)
    rules["invalid_dates"] = invalid_int_date((order, ship, due), (due,))
    rules["order_after_later"] = date_order_violated(order, (ship, due))
    return count_violations(df, rules)


def erp_customer_report(df: DataFrame, as_of: dt.date) -> DataFrame:
    return count_violations(
        df,
        {
            "null_cid": F.col("cid").isNull(),
            "prefixed_cid": F.col("cid").startswith("NAS"),
            "blanks_gen": text.has_stray_blanks("gen"),
            "bdate_out_of_range": dates.outside("bdate", dates.EARLIEST_BIRTH, as_of),
        },
    )
