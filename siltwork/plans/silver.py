"""Bronze to silver: cleansed, typed rows with lineage, failing rows quarantined.

The silver layout, the cleansing rules and the repair policies are given. How
they combine into a load, and the product and birth-date rules, are proposals of
this library.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions import amounts, codes, dates
from siltwork.operators.constraints import VIOLATIONS, conform
from siltwork.operators.keys import following_value, latest_per_key
from siltwork.operators.lineage import stamp_lineage
from siltwork.operators.lookups import lookup
from siltwork.operators.repair import POLICIES
from siltwork.operators.skew import DEFAULT_POLICY, SkewPolicy
from siltwork.plans.load_job import Loaded, batch_tag, now, run_batch
from siltwork.schemas import SPECS, TABLES
from siltwork.session import loading_session
from siltwork.sources.staging import StagedBatch, stage
from siltwork.sources.warehouse import Warehouse


@dataclass(frozen=True)
class SilverOptions:
    """Choices the data leaves open.

    ``marital_labels`` and ``line_labels`` spell out codes; without them codes
    are kept, trimmed and in upper case.
    """

    as_of: dt.date
    amount_policy: str = "recompute"
    marital_labels: Mapping[str, str] = field(default_factory=dict)
    line_labels: Mapping[str, str] = field(default_factory=dict)
    customer_tie_breakers: Sequence[str] | None = None
    skew: SkewPolicy = DEFAULT_POLICY


def _label(col: str, labels: Mapping[str, str]) -> Column:
    return codes.map_codes(col, labels) if labels else F.upper(F.trim(col))


def customers(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    newest = latest_per_key(bronze, "cst_id", "cst_create_date", options.customer_tie_breakers)
    return newest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        _label("cst_marital_status", options.marital_labels).alias("cst_marital_status"),
        codes.map_codes("cst_gndr", codes.GENDER_CODES).alias("cst_gndr"),
        "cst_create_date",
    )


def products(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    """Split the key into category and product; a version ends before the next later one.

    Versions that start on the same day all end before the next later day.
    """
    day = bronze.withColumn("__day", F.to_date("prd_start_dt"))
    days = following_value(
        day.select("prd_key", "__day").distinct(),
        "prd_key",
        "__day",
        "__day",
        "__next_start",
        skew=options.skew,
    )
    versions = lookup(day, days, ["prd_key", "__day"], options.skew, null_safe=True)
    return versions.select(
        "prd_id",
        F.replace(F.substring("prd_key", 1, 5), F.lit("-"), F.lit("_")).alias("cat_id"),
        F.substring("prd_key", 7, 50).alias("prd_key"),
        F.trim("prd_nm").alias("prd_nm"),
        "prd_cost",
        _label("prd_line", options.line_labels).alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        F.date_sub("__next_start", 1).alias("prd_end_dt"),
    )


def sales(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    repair, _ = POLICIES[options.amount_policy]
    fixed = repair(amounts.raw_amounts(bronze, "sls_sales", "sls_quantity", "sls_price"))
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *[dates.int_to_date(c).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        fixed.sales.alias("sls_sales"),
        fixed.quantity.alias("sls_quantity"),
        fixed.price.alias("sls_price"),
    )


def locations(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    return bronze.select(F.trim("cid").alias("cid"), F.trim("cntry").alias("cntry"))


def erp_customers(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    implausible = dates.outside("bdate", dates.EARLIEST_BIRTH, options.as_of)
    return bronze.select(
        codes.strip_prefix("cid").alias("cid"),
        F.when(~implausible, F.col("bdate")).alias("bdate"),
        codes.map_codes("gen", codes.GENDER_CODES_AND_WORDS).alias("gen"),
    )


def categories(bronze: DataFrame, options: SilverOptions) -> DataFrame:
    return bronze.select(*[F.trim(c).alias(c) for c in ("id", "cat", "subcat", "maintenance")])


TRANSFORMS: dict[str, Callable[[DataFrame, SilverOptions], DataFrame]] = {
    "crm_cust_info": customers,
    "crm_prd_info": products,
    "crm_sales_details": sales,
    "erp_loc_a101": locations,
    "erp_cust_az12": erp_customers,
    "erp_px_cat_g1v2": categories,
}


def silver_rows(table: str, bronze: DataFrame, options: SilverOptions) -> DataFrame:
    """Cleansed rows in the declared silver types, with the rules each row breaks."""
    return conform(TRANSFORMS[table](bronze, options), SPECS[table].declared("silver"))


def stage_checked(rows: DataFrame, path: str) -> StagedBatch:
    """Write checked rows once, those that break a rule apart from the others."""
    return stage(rows, VIOLATIONS, path)


def load_silver(
    warehouse: Warehouse,
    batch_id: int,
    options: SilverOptions,
    tables: Sequence[str] = TABLES,
    loaded_at: dt.datetime | None = None,
    on_error: str = "raise",
    at_once: int = 1,
    whole: bool = False,
) -> DataFrame:
    """Replace silver tables by the cleansed rows of the bronze ones.

    Rows that break a declared constraint stay beside the batch, under its
    ``_rejected=true`` folder, and are counted as rejects in the audit. ``at_once`` and
    ``whole`` as in ``run_batch``.
    """
    warehouse.create_layers()
    tag = batch_tag(batch_id)
    loaded_at = loaded_at or now()

    def load(table: str) -> Loaded:
        own = loading_session(warehouse.spark)
        bronze = own.table(warehouse.table_name("bronze", table))
        rows = silver_rows(table, bronze, options)
        stamped = stamp_lineage(rows, loaded_at, SPECS[table].source_system, batch_id)
        staged = stage_checked(stamped, warehouse.batch_path("silver", table, tag))
        return Loaded(staged.rows, staged.rejected, staged.good_path)

    loads = {t: (lambda t=t: load(t)) for t in tables}
    return run_batch(warehouse, "silver", batch_id, loads, on_error, at_once, whole)
