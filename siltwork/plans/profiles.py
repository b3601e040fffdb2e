"""All checks of a bronze table by name, ready to run before a silver load.

Nothing runs until a check is read, except that looking for hot keys in a large
table counts its keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions import codes
from siltwork.operators import checks, keys
from siltwork.operators.ordering import head_sample
from siltwork.operators.repair import POLICIES, repair_amounts
from siltwork.operators.skew import DEFAULT_POLICY, SkewPolicy
from siltwork.plans import quality
from siltwork.plans.customers import cleanse_customers


def customer_checks(df: DataFrame, skew: SkewPolicy = DEFAULT_POLICY) -> dict[str, DataFrame]:
    key, newest = "cst_id", "cst_create_date"
    return {
        "sample": head_sample(df, df.columns),
        "report": quality.customer_report(df),
        "key_violations": keys.pk_violations(df, key),
        "duplicate_rows": keys.duplicate_rows(df, key, skew=skew),
        "ranked_duplicates": keys.ranked_duplicates(df, key, newest, skew=skew),
        "superseded": keys.superseded_rows(df, key, newest, skew=skew),
        "latest": keys.latest_per_key(df, key, newest),
        "blanks_firstname": checks.whitespace_violations(df, ["cst_firstname"]),
        "blanks_names": checks.whitespace_violations(df, ["cst_firstname", "cst_lastname"]),
        "blanks_codes": checks.whitespace_violations(df, ["cst_gndr", "cst_marital_status"]),
        "marital_values": checks.domain_values(df, "cst_marital_status"),
        "gender_values": checks.domain_values(df, "cst_gndr"),
        "cleansed": cleanse_customers(df),
    }


def sales_checks(df: DataFrame) -> dict[str, DataFrame]:
    days = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    amounts = ("sls_sales", "sls_quantity", "sls_price")
    found = {
        "sample": head_sample(df, df.columns),
        "amount_report": quality.sales_amount_report(df, *amounts),
        "date_report": quality.sales_date_report(df, *days),
        "invalid_dates": checks.invalid_int_dates(df, days, bounded=["sls_due_dt"]),
        "date_order": checks.date_order_violations(df, days[0], days[1:]),
        "invalid_amounts": checks.amount_violations(df, *amounts),
        "distinct_invalid_amounts": checks.distinct_amount_violations(df, *amounts),
    }
    return found | {f"repair_{p}": repair_amounts(df, p, *amounts) for p in POLICIES}


def erp_customer_checks(df: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    return {
        "sample": head_sample(df, df.columns),
        "report": quality.erp_customer_report(df, as_of),
        "birth_dates_out_of_range": checks.date_out_of_range(df, "bdate", as_of),
        "gender_values": checks.domain_values(df, "gen"),
        "gender_mapping": checks.mapping_preview(
            df, "gen", codes.GENDER_CODES_AND_WORDS, "clean_gen"
        ),
        "clean_keys": df.select("cid", codes.strip_prefix(F.col("cid")).alias("clean_cid")),
    }
