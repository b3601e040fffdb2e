"""CRM customer checks and cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.fixtures import base, view, with_views
from contract.registry import query
from contract.values import label
from siltwork.functions import codes, text
from siltwork.operators import checks, keys, ordering
from siltwork.operators.lookups import lookup, one_per_key
from siltwork.operators.skew import SkewPolicy
from siltwork.plans.customers import cleanse_customers
from siltwork.plans.quality import customer_report

KEY, NEWEST, TIES = "cst_id", "cst_create_date", ["src_row"]

LABEL = label("cst_gndr", codes.GENDER_CODES)
NUMBERED = """row_number() over (partition by cst_id
              order by cst_create_date desc nulls last, src_row desc)"""
CLEANSED_SQL = with_views(
    "dirty_customers",
    f"""select cst_id, cst_key, trim(cst_firstname) as cst_firstname,
               trim(cst_lastname) as cst_lastname, {LABEL} as cst_gndr, cst_create_date
        from dirty_customers where cst_id is not null qualify {NUMBERED} = 1""",
)
STALE_SQL = with_views(
    "dirty_customers",
    f"""select *, {NUMBERED} as flag_latest_date from dirty_customers
        qualify flag_latest_date > 1""",
)
REPEATED_SQL = with_views(
    "dirty_customers",
    """select * from dirty_customers
       qualify cst_id is not null and count(*) over (partition by cst_id) > 1""",
)
RANKED_SQL = with_views(
    "dirty_customers",
    f"""select *, {NUMBERED} as flag_latest_date from dirty_customers
        qualify cst_id is null or count(*) over (partition by cst_id) > 1""",
)


def dirty(spark, sf_dir):
    return view(spark, sf_dir, "dirty_customers")


def spreading(df, parts):
    """A policy under which a key with more than one in ``parts`` rows is hot.

    Small tables then take the plans that very large ones need: the NULL key of
    the dirty customers, one row in 101, is hot for 200 parts.
    """
    return SkewPolicy(hot_rows=max(2, df.count() // parts))


@query(CLEANSED_SQL)
def cust_cleansed(spark, sf_dir):
    return cleanse_customers(dirty(spark, sf_dir), TIES)


@query(
    with_views(
        "dirty_customers",
        f"""select * from dirty_customers where cst_id is not null
            qualify {NUMBERED} = 1""",
    )
)
def cust_latest(spark, sf_dir):
    return keys.latest_per_key(dirty(spark, sf_dir), KEY, NEWEST, TIES)


@query(STALE_SQL)
def cust_stale_versions(spark, sf_dir):
    return keys.superseded_rows(dirty(spark, sf_dir), KEY, NEWEST, TIES)


@query(STALE_SQL)
def cust_stale_versions_spread(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    return keys.superseded_rows(rows, KEY, NEWEST, TIES, skew=spreading(rows, 200))


@query(
    with_views(
        "dirty_customers",
        """select cst_id, count(*) as n from dirty_customers group by cst_id
           having n > 1 or cst_id is null""",
    )
)
def pk_null_or_duplicate(spark, sf_dir):
    return keys.pk_violations(dirty(spark, sf_dir), KEY)


@query(REPEATED_SQL)
def dup_rows_in(spark, sf_dir):
    return keys.duplicate_rows(dirty(spark, sf_dir), KEY)


@query(REPEATED_SQL)
def dup_rows_in_spread(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    # Cut finer, for the NULL key is left out here.
    return keys.duplicate_rows(rows, KEY, skew=spreading(rows, 900))


@query(
    with_views(
        "dirty_customers",
        """select * from dirty_customers
           qualify cst_id is null or count(*) over (partition by cst_id) > 1""",
    )
)
def dup_rows_or_null(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    return keys.duplicate_rows(rows, KEY, include_null=True, skew=spreading(rows, 200))


@query(RANKED_SQL)
def dup_rows_ranked(spark, sf_dir):
    return keys.ranked_duplicates(dirty(spark, sf_dir), KEY, NEWEST, TIES)


@query(RANKED_SQL)
def dup_rows_ranked_spread(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    return keys.ranked_duplicates(rows, KEY, NEWEST, TIES, skew=spreading(rows, 200))


@query(
    with_views(
        "dirty_customers",
        "select cst_firstname from dirty_customers where cst_firstname <> trim(cst_firstname)",
    )
)
def whitespace_single(spark, sf_dir):
    return checks.whitespace_violations(dirty(spark, sf_dir), ["cst_firstname"])


@query(
    with_views(
        "dirty_customers",
        """select cst_firstname, cst_lastname from dirty_customers
           where cst_firstname <> trim(cst_firstname) or cst_lastname <> trim(cst_lastname)""",
    )
)
def whitespace_multi(spark, sf_dir):
    return checks.whitespace_violations(dirty(spark, sf_dir), ["cst_firstname", "cst_lastname"])


@query(
    with_views(
        "dirty_customers",
        """select cst_gndr, cst_marital_status from dirty_customers
           where cst_gndr <> trim(cst_gndr) or cst_marital_status <> trim(cst_marital_status)""",
    )
)
def whitespace_codes(spark, sf_dir):
    return checks.whitespace_violations(dirty(spark, sf_dir), ["cst_gndr", "cst_marital_status"])


@query(
    with_views(
        "dirty_customers",
        """select cst_firstname from dirty_customers
           where rtrim(cst_firstname) <> trim(cst_firstname)""",
    )
)
def whitespace_leading_only(spark, sf_dir):
    found = checks.whitespace_violations(dirty(spark, sf_dir), ["cst_firstname"], text.PADDED)
    return found


@query(with_views("dirty_customers", "select distinct cst_gndr from dirty_customers"))
def domain_values(spark, sf_dir):
    return checks.domain_values(dirty(spark, sf_dir), "cst_gndr")


@query(with_views("dirty_customers", "select distinct cst_marital_status from dirty_customers"))
def domain_values_marital(spark, sf_dir):
    return checks.domain_values(dirty(spark, sf_dir), "cst_marital_status")


@query(
    with_views(
        "dirty_customers",
        """select min(cst_gndr) as cst_gndr from dirty_customers
           group by lower(rtrim(cst_gndr))""",
    )
)
def domain_values_any_case(spark, sf_dir):
    return checks.domain_values(dirty(spark, sf_dir), "cst_gndr", text.PADDED_ANY_CASE)


@query(
    with_views(
        "dirty_customers",
        f"select src_row, cst_gndr, {LABEL} as clean_gndr from dirty_customers",
    )
)
def gender_standardize(spark, sf_dir):
    label = codes.map_codes("cst_gndr", codes.GENDER_CODES)
    return dirty(spark, sf_dir).select("src_row", "cst_gndr", label.alias("clean_gndr"))


@query(
    """select c_custkey, c_name, c_mktsegment from customer
       order by c_custkey limit 1000"""
)
def head_sample(spark, sf_dir):
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    return ordering.head_sample(base(spark, sf_dir, "customer"), cols, order=["c_custkey"])


@query(
    with_views(
        "dirty_customers",
        """select cst_id, cst_key, src_row from dirty_customers
           order by cst_key, src_row limit 1000""",
    )
)
def head_sample_spread(spark, sf_dir):
    cols = ["cst_id", "cst_key", "src_row"]
    order = ["cst_key", "src_row"]
    return ordering.head_sample(dirty(spark, sf_dir), cols, order=order)


@query(
    with_views(
        "dirty_customers",
        """select count(*) as rows, cast(count_if(cst_id is null) as bigint) as null_cst_id,
             cast(count_if(cst_firstname <> trim(cst_firstname)) as bigint)
               as blanks_cst_firstname,
             cast(count_if(cst_lastname <> trim(cst_lastname)) as bigint) as blanks_cst_lastname,
             cast(count_if(cst_gndr <> trim(cst_gndr)) as bigint) as blanks_cst_gndr,
             cast(count_if(cst_marital_status <> trim(cst_marital_status)) as bigint)
               as blanks_cst_marital_status
           from dirty_customers""",
    )
)
def dq_report_customers(spark, sf_dir):
    return customer_report(dirty(spark, sf_dir))


# -- keys under a collation ------------------------------------------------------

SPELLED = ["cst_key", "cst_gndr"]


@query(
    with_views(
        "dirty_customers",
        """select min(cst_gndr) as cst_gndr, count(*) as n from dirty_customers
           group by lower(rtrim(cst_gndr)) having count(*) > 1 or min(cst_gndr) is null""",
    )
)
def pk_null_or_duplicate_any_case(spark, sf_dir):
    """Keys that differ by case or trailing blanks only are one key."""
    return keys.pk_violations(dirty(spark, sf_dir), "cst_gndr", collation=text.PADDED_ANY_CASE)


ANY_CASE_SQL = with_views(
    "dirty_customers",
    """select * from dirty_customers qualify cst_gndr is not null
       and count(*) over (partition by lower(rtrim(cst_key)), lower(rtrim(cst_gndr))) > 1""",
)


@query(ANY_CASE_SQL)
def dup_rows_any_case(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    return keys.duplicate_rows(rows, SPELLED, collation=text.PADDED_ANY_CASE)


@query(ANY_CASE_SQL)
def dup_rows_any_case_spread(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    return keys.duplicate_rows(
        rows, SPELLED, skew=SkewPolicy(hot_rows=2), collation=text.PADDED_ANY_CASE
    )


@query(
    with_views(
        "dirty_customers dirty_erp_customers",
        """, t as (
             select lower(rtrim(gen)) as k, max(cid) as cid from dirty_erp_customers
             where gen is not null group by 1)
           select src_row, cst_gndr, cid from dirty_customers
           left join t on lower(rtrim(cst_gndr)) = k""",
    )
)
def lookup_any_case(spark, sf_dir):
    """The last ERP customer of a gender, however it is written."""
    erp = view(spark, sf_dir, "dirty_erp_customers").select(F.col("gen").alias("cst_gndr"), "cid")
    last = one_per_key(erp, "cst_gndr", ["cid"], collation=text.PADDED_ANY_CASE)
    rows = dirty(spark, sf_dir).select("src_row", "cst_gndr")
    return lookup(rows, last, "cst_gndr", collation=text.PADDED_ANY_CASE)
