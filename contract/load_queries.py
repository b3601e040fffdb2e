"""Ingest, constraints, silver and gold."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from contract.customer_queries import spreading
from contract.erp_queries import AS_OF
from contract.fixtures import base, view, with_views
from contract.registry import query
from contract.values import label, repaired
from siltwork.functions import codes, dates
from siltwork.operators import constraints, keys, lookups
from siltwork.operators.lineage import stamp_lineage
from siltwork.operators.skew import DEFAULT_POLICY, SkewPolicy
from siltwork.plans import gold
from siltwork.plans.bronze import load_bronze
from siltwork.plans.load_job import ALL_TABLES, read_audit
from siltwork.plans.silver import SilverOptions, load_silver, silver_rows, stage_checked
from siltwork.schemas import LINEAGE_COLUMNS, SPECS
from siltwork.session import scratch_path, write_out
from siltwork.sources.delimited import BAD_LINE, stage_delimited, write_delimited
from siltwork.sources.warehouse import Warehouse

LOADED_AT = dt.datetime(2026, 1, 1, 6, 30, 0)
# Labels are not given anywhere; these are examples.
OPTIONS = SilverOptions(
    as_of=AS_OF,
    marital_labels={"S": "Single", "M": "Married"},
    line_labels={"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"},
)
# Every product key with three versions is hot.
SPREAD_OPTIONS = SilverOptions(
    as_of=AS_OF,
    line_labels=OPTIONS.line_labels,
    skew=SkewPolicy(hot_rows=3),
)
BRONZE_VIEWS = {
    "crm_cust_info": "dirty_customers",
    "crm_prd_info": "dirty_products",
    "crm_sales_details": "dirty_crm_sales",
    "erp_loc_a101": "dirty_locations",
    "erp_cust_az12": "dirty_erp_customers",
    "erp_px_cat_g1v2": "dirty_categories",
}


def bronze(spark, sf_dir, table):
    """Rows of a bronze table as derived from the test tables."""
    rows = view(spark, sf_dir, BRONZE_VIEWS[table])
    return rows.select(*SPECS[table].readable("bronze").names)


def extract(spark, sf_dir, table):
    """A delimited extract of those rows; returns its path."""
    path = scratch_path(spark, f"extract-{table}")
    write_delimited(bronze(spark, sf_dir, table), path)
    return path


def broken_extract(spark, sf_dir):
    """The extract with broken lines in eight files, all lines ended by CR and LF."""
    path = scratch_path(spark, "extract-broken")
    lines = view(spark, sf_dir, "extract_lines").select(
        "line", F.pmod(F.hash("line"), F.lit(8)).alias("file"), F.lit(1).alias("place")
    )
    heads = spark.range(8).select(
        F.lit("cid,bdate,gen"), F.col("id").cast("int"), F.lit(0)
    )
    rows = lines.union(heads).repartition("file").sortWithinPartitions("file", "place")
    rows.select("line", "file").write.partitionBy("file").text(path, lineSep="\r\n")
    return path


def new_warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "warehouse"), f"w{uuid.uuid4().hex[:8]}_")


# -- sources and load job ------------------------------------------------------


@query(
    with_views(
        "dirty_customers",
        """select cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr,
                  cst_create_date from dirty_customers""",
    )
)
def bronze_csv_ingest(spark, sf_dir):
    warehouse = new_warehouse(spark)
    load_bronze(warehouse, {"crm_cust_info": extract(spark, sf_dir, "crm_cust_info")}, 1)
    return warehouse.table("bronze", "crm_cust_info")


def staged_lines(spark, sf_dir):
    return stage_delimited(
        spark,
        broken_extract(spark, sf_dir),
        SPECS["erp_cust_az12"].declared("bronze"),
        scratch_path(spark, "staged"),
    )


@query(with_views("extract_lines", "select line from extract_lines where broken"))
def bronze_csv_rejects(spark, sf_dir):
    return staged_lines(spark, sf_dir).rejects().select(F.col(BAD_LINE).alias("line"))


@query(with_views("extract_lines", "select cid, bdate, gen from extract_lines where not broken"))
def bronze_csv_accepted(spark, sf_dir):
    return staged_lines(spark, sf_dir).good_rows()


@query(
    with_views(
        "dirty_erp_customers",
        "select cid, bdate, nullif(gen, '') as gen from dirty_erp_customers",
    )
)
def bronze_full_refresh(spark, sf_dir):
    """Two loads of one table, the first from other rows: the second wins."""
    warehouse = new_warehouse(spark)
    first = scratch_path(spark, "extract-first")
    older = view(spark, sf_dir, "extract_lines").where("not broken").select("cid", "bdate", "gen")
    write_delimited(older, first)
    load_bronze(warehouse, {"erp_cust_az12": first}, 1)
    load_bronze(warehouse, {"erp_cust_az12": extract(spark, sf_dir, "erp_cust_az12")}, 2)
    return warehouse.table("bronze", "erp_cust_az12")


@query(
    f"""select 'crm_cust_info' as table_name, 'SUCCEEDED' as status, count(*) as rows,
               cast(0 as bigint) as rejects from orders
        union all select 'erp_loc_a101', 'SUCCEEDED', count(*), 0 from customer
        union all select 'erp_cust_az12', 'FAILED', null, null
        union all select 'erp_px_cat_g1v2', 'SKIPPED', null, null
        union all select '{ALL_TABLES}', 'FAILED', null, null"""
)
def load_audit_summary(spark, sf_dir):
    """A batch whose third table has too many bad lines."""
    extracts = {
        table: extract(spark, sf_dir, table)
        for table in ("crm_cust_info", "erp_loc_a101", "erp_px_cat_g1v2")
    }
    extracts["erp_cust_az12"] = broken_extract(spark, sf_dir)
    audit = load_bronze(new_warehouse(spark), extracts, 1, on_error="record")
    return audit.select("table_name", "status", "rows", "rejects")


# -- constraints, types, lineage -----------------------------------------------


@query(
    with_views(
        "dirty_sales_dates",
        """select l_orderkey, l_linenumber,
                  cast(try_strptime(cast(sls_order_dt as varchar), '%Y%m%d') as date)
                    as sls_order_dt,
                  cast(try_strptime(cast(sls_ship_dt as varchar), '%Y%m%d') as date)
                    as sls_ship_dt,
                  cast(try_strptime(cast(sls_due_dt as varchar), '%Y%m%d') as date)
                    as sls_due_dt
           from dirty_sales_dates""",
    )
)
def silver_typed_schema(spark, sf_dir):
    cols = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    return view(spark, sf_dir, "dirty_sales_dates").select(
        "l_orderkey", "l_linenumber", *[dates.int_to_date(c).alias(c) for c in cols]
    )


@query(
    """select c_custkey, c_name, timestamp '2026-01-01 06:30:00' as dwh_load_datetime,
              'CRM' as dwh_source_system, cast(7 as int) as dwh_batch_id from customer"""
)
def silver_lineage_stamp(spark, sf_dir):
    rows = base(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return stamp_lineage(rows, LOADED_AT, "CRM", 7)


@query(with_views("dirty_customers", "select * from dirty_customers where cst_id is null"))
def not_null_quarantine(spark, sf_dir):
    rules = constraints.null_rules(["cst_id", "cst_key"])
    tagged = constraints.tag_violations(view(spark, sf_dir, "dirty_customers"), rules)
    return constraints.quarantined(tagged).drop(constraints.VIOLATIONS)


@query(
    with_views(
        "dirty_erp_customers",
        """select cid, bdate, gen, 'cid longer than 10' as violation
           from dirty_erp_customers where length(cid) > 10""",
    )
)
def length_limit_quarantine(spark, sf_dir):
    rules = constraints.length_rules({"cid": 10})
    tagged = constraints.tag_violations(view(spark, sf_dir, "dirty_erp_customers"), rules)
    found = constraints.quarantined(tagged)
    return found.withColumnRenamed(constraints.VIOLATIONS, "violation")


@query(
    with_views(
        "dirty_locations",
        """select cid, trim(cntry) as cntry, true as stamped, 'ERP' as dwh_source_system,
                  cast(5 as int) as dwh_batch_id from dirty_locations""",
    )
)
def silver_column_default(spark, sf_dir):
    """Rows inserted into a declared table without a load time get one."""
    warehouse = new_warehouse(spark)
    warehouse.create_layers()
    warehouse.recreate_tables("silver")
    warehouse.recreate_tables("silver")
    spark.sql(
        f"""insert into {warehouse.table_name("silver", "erp_loc_a101")}
              (cid, cntry, dwh_source_system, dwh_batch_id)
            select cid, cntry, 'ERP', 5 from {{rows}}""",
        rows=silver(spark, sf_dir, "erp_loc_a101"),
    )
    stamped = F.col("dwh_load_datetime").isNotNull().alias("stamped")
    return warehouse.table("silver", "erp_loc_a101").select(
        "cid", "cntry", stamped, *LINEAGE_COLUMNS[1:]
    )


@query(with_views("dirty_locations", "select cid from dirty_locations where cntry is null"))
def recreated_table(spark, sf_dir):
    """All rows are inserted, the table is recreated, then some are: only those are left."""
    warehouse = new_warehouse(spark)
    warehouse.create_layers()
    warehouse.recreate_table("silver", "erp_loc_a101")
    rows = silver(spark, sf_dir, "erp_loc_a101")
    insert = f"""insert into {warehouse.table_name("silver", "erp_loc_a101")}
                   (cid, cntry, dwh_source_system, dwh_batch_id)
                 select cid, cntry, 'ERP', 5 from {{rows}}"""
    spark.sql(insert, rows=rows)
    warehouse.recreate_table("silver", "erp_loc_a101")
    spark.sql(insert, rows=rows.where("cntry is null"))
    return warehouse.table("silver", "erp_loc_a101").select("cid")


# -- silver --------------------------------------------------------------------

CUSTOMERS_SQL = f"""
    select cst_id, cst_key, trim(cst_firstname) as cst_firstname,
           trim(cst_lastname) as cst_lastname,
           {label("cst_marital_status", OPTIONS.marital_labels)} as cst_marital_status,
           {label("cst_gndr", codes.GENDER_CODES)} as cst_gndr,
           cst_create_date
    from dirty_customers where cst_id is not null
    qualify row_number() over (
      partition by cst_id
      order by cst_create_date desc nulls last, cst_key desc nulls last,
               cst_firstname desc nulls last, cst_lastname desc nulls last,
               cst_marital_status desc nulls last, cst_gndr desc nulls last) = 1"""
PRODUCTS_SQL = f"""
    select prd_id, replace(left(prd_key, 5), '-', '_') as cat_id,
           substr(prd_key, 7) as prd_key, trim(prd_nm) as prd_nm,
           cast(prd_cost as decimal(18,2)) as prd_cost,
           {label("prd_line", OPTIONS.line_labels)} as prd_line,
           prd_start_dt,
           cast(min(prd_start_dt) over (partition by dirty_products.prd_key order by prd_start_dt
                range between interval 1 day following and unbounded following)
                - interval 1 day as date) as prd_end_dt
    from dirty_products"""
_SALES, _QUANTITY, _PRICE = repaired("sls_sales", "sls_quantity", "sls_price")
SALES_SQL = f"""
    select sls_ord_num, sls_prd_key, sls_cust_id,
           cast(try_strptime(cast(sls_order_dt as varchar), '%Y%m%d') as date) as sls_order_dt,
           cast(try_strptime(cast(sls_ship_dt as varchar), '%Y%m%d') as date) as sls_ship_dt,
           cast(try_strptime(cast(sls_due_dt as varchar), '%Y%m%d') as date) as sls_due_dt,
           cast({_SALES} as decimal(18,2)) as sls_sales,
           cast({_QUANTITY} as int) as sls_quantity,
           cast({_PRICE} as decimal(18,2)) as sls_price
    from dirty_crm_sales where sls_cust_id is not null"""
ERP_CUSTOMERS_SQL = f"""
    select regexp_replace(cid, '^NAS', '') as cid,
           case when bdate between date '1924-01-01' and date '2026-01-01' then bdate end
             as bdate,
           {label("gen", codes.GENDER_CODES_AND_WORDS)} as gen
    from dirty_erp_customers"""
LOCATIONS_SQL = "select cid, trim(cntry) as cntry from dirty_locations"
CATEGORIES_SQL = "select id, cat, subcat, maintenance from dirty_categories"


def silver(spark, sf_dir, table, options=OPTIONS):
    """Accepted silver rows, staged from the derived bronze rows as a load does."""
    rows = silver_rows(table, bronze(spark, sf_dir, table), options)
    return stage_checked(rows, scratch_path(spark, f"silver-{table}")).good_rows()


@query(with_views("dirty_customers", CUSTOMERS_SQL))
def silver_customers(spark, sf_dir):
    return silver(spark, sf_dir, "crm_cust_info")


@query(with_views("dirty_products", PRODUCTS_SQL))
def silver_products(spark, sf_dir):
    return silver(spark, sf_dir, "crm_prd_info")


@query(with_views("dirty_products", PRODUCTS_SQL))
def silver_products_spread(spark, sf_dir):
    return silver(spark, sf_dir, "crm_prd_info", SPREAD_OPTIONS)


@query(with_views("dirty_crm_sales", SALES_SQL))
def silver_sales(spark, sf_dir):
    return silver(spark, sf_dir, "crm_sales_details")


@query(with_views("dirty_erp_customers", ERP_CUSTOMERS_SQL))
def silver_erp_customers(spark, sf_dir):
    return silver(spark, sf_dir, "erp_cust_az12")


@query(with_views("dirty_locations", LOCATIONS_SQL))
def silver_locations(spark, sf_dir):
    return silver(spark, sf_dir, "erp_loc_a101")


@query(with_views("dirty_categories", CATEGORIES_SQL))
def silver_categories(spark, sf_dir):
    return silver(spark, sf_dir, "erp_px_cat_g1v2")


@query(
    with_views(
        "dirty_products dirty_crm_sales dirty_erp_customers",
        f"""select 'crm_prd_info' as table_name, count(*) as rows, cast(0 as bigint) as rejects,
                   cast(count(prd_end_dt) as bigint) as dated, 'CRM' as dwh_source_system,
                   cast(2 as int) as dwh_batch_id
            from ({PRODUCTS_SQL})
            union all
            select 'crm_sales_details', count(*),
                   (select count(*) from dirty_crm_sales where sls_cust_id is null),
                   count(sls_order_dt), 'CRM', 2 from ({SALES_SQL})
            union all
            select 'erp_cust_az12', count(*), 0, count(bdate), 'ERP', 2
            from ({ERP_CUSTOMERS_SQL})""",
    )
)
def silver_load(spark, sf_dir):
    """Extracts to bronze to silver through the catalog; counts per table."""
    dated = {
        "crm_prd_info": "prd_end_dt",
        "crm_sales_details": "sls_order_dt",
        "erp_cust_az12": "bdate",
    }
    warehouse = new_warehouse(spark)
    load_bronze(warehouse, {t: extract(spark, sf_dir, t) for t in dated}, 1)
    audit = load_silver(warehouse, 2, OPTIONS, list(dated), LOADED_AT)
    counted = [
        warehouse.table("silver", table)
        .groupBy(*LINEAGE_COLUMNS[1:])
        .agg(F.count(F.lit(1)).alias("rows"), F.count(col).alias("dated"))
        .withColumn("table_name", F.lit(table))
        for table, col in dated.items()
    ]
    result = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return result.join(audit.select("table_name", "rejects"), "table_name")


# -- gold ----------------------------------------------------------------------

DIM_CUSTOMERS_SQL = f"""
    select cst_id as customer_id, cst_key as customer_key, cst_firstname as first_name,
           cst_lastname as last_name, cst_marital_status as marital_status,
           case when cst_gndr <> 'N/A' then cst_gndr else coalesce(gen, 'N/A') end as gender,
           bdate as birth_date, cntry as country, cst_create_date as created
    from silver_customers
    left join (select * from silver_erp_customers qualify row_number() over (
                 partition by cid order by bdate desc nulls last, gen desc nulls last) = 1) e
      on cst_key = e.cid
    left join (select * from silver_locations qualify row_number() over (
                 partition by cid order by cntry desc nulls last) = 1) l
      on cst_key = l.cid"""
DIM_PRODUCTS_SQL = f"""
    select prd_key as product_key, prd_id as product_id, prd_nm as product_name,
           cat_id as category_id, prd_line as product_line, prd_cost as cost,
           prd_start_dt as start_date, cat as category, subcat as subcategory, maintenance
    from (select * from silver_products where prd_end_dt is null
          qualify row_number() over (
            partition by prd_key order by prd_start_dt desc, prd_id desc) = 1)
    left join (select * from silver_categories qualify row_number() over (
                 partition by id order by cat desc, subcat desc, maintenance desc) = 1)
      on cat_id = id"""
FACT_SQL = """
    select sls_ord_num as order_number, sls_prd_key as product_key, sls_cust_id as customer_id,
           sls_order_dt as order_date, sls_ship_dt as ship_date, sls_due_dt as due_date,
           sls_sales as sales, sls_quantity as quantity, sls_price as price,
           product_id, customer_key
    from silver_sales
    left join (select product_key, product_id from dim_products) on sls_prd_key = product_key
    left join (select customer_id, customer_key from dim_customers) on sls_cust_id = customer_id"""


def stacked(query_text):
    """``query_text`` over the silver and gold tables, each defined by its SQL."""
    views = " ".join(BRONZE_VIEWS.values())
    tables = {
        "silver_customers": CUSTOMERS_SQL,
        "silver_products": PRODUCTS_SQL,
        "silver_sales": SALES_SQL,
        "silver_erp_customers": ERP_CUSTOMERS_SQL,
        "silver_locations": LOCATIONS_SQL,
        "silver_categories": CATEGORIES_SQL,
        "dim_customers": DIM_CUSTOMERS_SQL,
        "dim_products": DIM_PRODUCTS_SQL,
    }
    definitions = ", ".join(f"{name} as ({sql})" for name, sql in tables.items())
    return with_views(views, f", {definitions}\n{query_text}")


def dim_customers(spark, sf_dir):
    tables = ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")
    return gold.customer_dimension(*[silver(spark, sf_dir, t) for t in tables])


def dim_products(spark, sf_dir):
    tables = ("crm_prd_info", "erp_px_cat_g1v2")
    return gold.product_dimension(*[silver(spark, sf_dir, t) for t in tables])


def fact(spark, sf_dir, skew_of):
    sales = silver(spark, sf_dir, "crm_sales_details")
    return gold.sales_fact(
        sales,
        write_out(dim_customers(spark, sf_dir), "dim-customers"),
        write_out(dim_products(spark, sf_dir), "dim-products"),
        skew_of(sales),
    )


@query(stacked("select * from dim_customers"))
def gold_customers(spark, sf_dir):
    return dim_customers(spark, sf_dir)


@query(stacked("select * from dim_products"))
def gold_products(spark, sf_dir):
    return dim_products(spark, sf_dir)


@query(stacked(FACT_SQL))
def gold_sales(spark, sf_dir):
    return fact(spark, sf_dir, lambda sales: DEFAULT_POLICY)


@query(stacked(FACT_SQL))
def gold_sales_spread(spark, sf_dir):
    return fact(spark, sf_dir, lambda sales: spreading(sales, 2000))


SILVER_VIEWS = {
    "crm_cust_info": "silver_customers",
    "crm_prd_info": "silver_products",
    "crm_sales_details": "silver_sales",
    "erp_loc_a101": "silver_locations",
    "erp_cust_az12": "silver_erp_customers",
    "erp_px_cat_g1v2": "silver_categories",
}
# A sales line keeps its row in the fact table, whatever the dimensions hold.
GOLD_VIEWS = {
    "dim_customers": "dim_customers", "dim_products": "dim_products", "fact_sales": "silver_sales",
}


def _counts_sql():
    """Rows and rejects per layer and table, as the audit of a whole load has them."""
    nobody = "(select count(*) from dirty_crm_sales where sls_cust_id is null)"
    layers = {"bronze": BRONZE_VIEWS, "silver": SILVER_VIEWS, "gold": GOLD_VIEWS}
    selects = [
        f"""select '{layer}' as layer, '{table}' as table_name, count(*) as rows,
              cast({nobody if (layer, table) == ("silver", "crm_sales_details") else 0} as bigint)
                as rejects from {name}"""
        for layer, views in layers.items()
        for table, name in views.items()
    ]
    return " union all ".join(selects)


@query(stacked(_counts_sql()))
def warehouse_load(spark, sf_dir):
    """Six extracts to bronze, silver and gold; rows per layer and table from the audit."""
    warehouse = new_warehouse(spark)
    load_bronze(warehouse, {t: extract(spark, sf_dir, t) for t in BRONZE_VIEWS}, 1)
    load_silver(warehouse, 2, OPTIONS, loaded_at=LOADED_AT)
    gold.load_gold(warehouse, 3)
    return (
        read_audit(warehouse)
        .where(F.col("table_name") != ALL_TABLES)
        .select("layer", "table_name", "rows", "rejects")
    )


@query(
    stacked(
        """select prd_id, prd_key, cat_id from silver_products
           where not exists (select 1 from silver_categories where id = cat_id)"""
    )
)
def orphan_products(spark, sf_dir):
    products = silver(spark, sf_dir, "crm_prd_info").select("prd_id", "prd_key", "cat_id")
    categories = silver(spark, sf_dir, "erp_px_cat_g1v2").select(F.col("id").alias("cat_id"))
    return lookups.orphans(products, categories, "cat_id", spreading(products, 200))


@query(
    with_views(
        "dirty_products",
        """select *, lead(prd_start_dt) over (partition by prd_key order by prd_start_dt, prd_id)
             as next_start from dirty_products""",
    )
)
def product_next_start(spark, sf_dir):
    return keys.following_value(
        view(spark, sf_dir, "dirty_products"), "prd_key", "prd_start_dt", "prd_start_dt",
        "next_start",
    )


@query(
    with_views(
        "dirty_products",
        """select prd_id, prd_line, prd_start_dt, lead(prd_id) over (partition by prd_line
             order by prd_start_dt, prd_id) as next_id from dirty_products""",
    )
)
def product_next_in_line(spark, sf_dir):
    """Few keys with very many rows each, NULL among them: all of them are spread."""
    products = view(spark, sf_dir, "dirty_products").select("prd_id", "prd_line", "prd_start_dt")
    return keys.following_value(
        products,
        "prd_line",
        "prd_start_dt",
        "prd_id",
        "next_id",
        ["prd_id"],
        spreading(products, 20),
    )
