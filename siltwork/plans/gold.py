"""Conformed tables for reports. No rules are given for this layer; all are ours.

Rows keep their natural keys. Numbering them for surrogate keys would put a whole
table in order for no gain in a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions.codes import UNKNOWN
from siltwork.operators.lookups import lookup, one_per_key
from siltwork.operators.skew import DEFAULT_POLICY, SkewPolicy
from siltwork.plans.load_job import Loaded, batch_tag, run_batch
from siltwork.sources.staging import write_counted
from siltwork.sources.warehouse import Warehouse


def customer_dimension(
    customers: DataFrame,
    erp_customers: DataFrame,
    locations: DataFrame,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per customer; the CRM gender counts, the ERP fills in for unknown.

    Two spellings of an ERP key may become one key. The row with the latest
    birth date then counts, and of several countries the last by name.
    """
    people = customers.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_key"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cst_marital_status").alias("marital_status"),
        F.col("cst_gndr").alias("crm_gender"),
        F.col("cst_create_date").alias("created"),
    )
    births = erp_customers.select(
        F.col("cid").alias("customer_key"),
        F.col("bdate").alias("birth_date"),
        F.col("gen").alias("erp_gender"),
    )
    countries = locations.select(
        F.col("cid").alias("customer_key"), F.col("cntry").alias("country")
    )
    births = one_per_key(births, "customer_key", ["birth_date"])
    countries = one_per_key(countries, "customer_key", ["country"])
    joined = lookup(lookup(people, births, "customer_key", skew), countries, "customer_key", skew)
    gender = F.when(F.col("crm_gender") != UNKNOWN, F.col("crm_gender")).otherwise(
        F.coalesce("erp_gender", F.lit(UNKNOWN))
    )
    return joined.select(
        "customer_id",
        "customer_key",
        "first_name",
        "last_name",
        "marital_status",
        gender.alias("gender"),
        "birth_date",
        "country",
        "created",
    )


def product_dimension(
    products: DataFrame, categories: DataFrame, skew: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row per product: its current version, with its category where it is known.

    Products of two categories may share a key once the category is split off,
    and versions may start on one day. The latest start counts, then the highest id.
    """
    current = products.where(F.col("prd_end_dt").isNull()).select(
        F.col("prd_key").alias("product_key"),
        F.col("prd_id").alias("product_id"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_start_dt").alias("start_date"),
    )
    named = categories.select(
        F.col("id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
    )
    current = one_per_key(current, "product_key", ["start_date", "product_id"])
    return lookup(current, one_per_key(named, "category_id"), "category_id", skew)


def sales_fact(
    sales: DataFrame,
    customer_dimension: DataFrame,
    product_dimension: DataFrame,
    skew: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Sales lines with the customer and product they belong to, NULL where unknown.

    As many rows as ``sales`` has; the dimensions hold each key once.
    """
    lines = sales.select(
        F.col("sls_ord_num").alias("order_number"),
        F.col("sls_prd_key").alias("product_key"),
        F.col("sls_cust_id").alias("customer_id"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("ship_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )
    with_product = lookup(
        lines, product_dimension.select("product_key", "product_id"), "product_key", skew
    )
    return lookup(
        with_product, customer_dimension.select("customer_id", "customer_key"), "customer_id", skew
    )


def load_gold(
    warehouse: Warehouse,
    batch_id: int,
    skew: SkewPolicy = DEFAULT_POLICY,
    on_error: str = "raise",
) -> DataFrame:
    """Replace the gold tables by what the silver ones give, dimensions first."""
    warehouse.create_layers()
    tag = batch_tag(batch_id)

    def silver(table: str) -> DataFrame:
        return warehouse.table("silver", table)

    def save(table: str, build: Callable[[], DataFrame]) -> Loaded:
        rows = build()
        path = warehouse.batch_path("gold", table, tag)
        counts = write_counted(rows, path, {"rows": F.count(F.lit(1))})
        ddl = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
        return Loaded(counts["rows"], 0, path, ddl)

    builds = {
        "dim_customers": lambda: customer_dimension(
            silver("crm_cust_info"), silver("erp_cust_az12"), silver("erp_loc_a101"), skew
        ),
        "dim_products": lambda: product_dimension(
            silver("crm_prd_info"), silver("erp_px_cat_g1v2"), skew
        ),
        "fact_sales": lambda: sales_fact(
            silver("crm_sales_details"),
            warehouse.table("gold", "dim_customers"),
            warehouse.table("gold", "dim_products"),
            skew,
        ),
    }
    loads = {t: (lambda t=t, b=b: save(t, b)) for t, b in builds.items()}
    return run_batch(warehouse, "gold", batch_id, loads, on_error)
