"""CRM sales checks and repairs."""

from __future__ import annotations

from contract.fixtures import view, with_views
from contract.registry import query
from contract.values import repaired
from siltwork.operators import checks
from siltwork.operators.repair import repair_amounts
from siltwork.plans.quality import sales_amount_report, sales_date_report

DATES = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
AMOUNTS = ("s", "q", "p")
LINE = ("l_orderkey", "l_linenumber")

# Conditions on the raw amounts, for the SQL side.
MISSING = "(s is null or q is null or p is null or least(s, q, p) <= 0)"
S, Q, P = repaired("s", "q", "p")
INCONSISTENT = f"({MISSING} or s <> cast(q as bigint) * p)"
RAW = "l_orderkey, l_linenumber, s as old_sales, q as old_qty, p as old_price"


def dirty(spark, sf_dir):
    return view(spark, sf_dir, "dirty_sales")


@query(
    with_views(
        "dirty_sales_dates",
        """select * from dirty_sales_dates
           where sls_order_dt is null or sls_ship_dt is null or sls_due_dt is null
              or length(cast(sls_order_dt as varchar)) <> 8
              or length(cast(sls_ship_dt as varchar)) <> 8
              or length(cast(sls_due_dt as varchar)) <> 8
              or sls_due_dt not between 19990101 and 20300101""",
    )
)
def sales_invalid_dates(spark, sf_dir):
    return checks.invalid_int_dates(
        view(spark, sf_dir, "dirty_sales_dates"), DATES, bounded=["sls_due_dt"]
    )


@query(
    with_views(
        "dirty_sales_dates",
        """select * from dirty_sales_dates
           where sls_order_dt > sls_ship_dt or sls_order_dt > sls_due_dt""",
    )
)
def sales_date_order(spark, sf_dir):
    return checks.date_order_violations(
        view(spark, sf_dir, "dirty_sales_dates"), "sls_order_dt", ["sls_ship_dt", "sls_due_dt"]
    )


@query(with_views("dirty_sales", f"select * from dirty_sales where {INCONSISTENT}"))
def sales_invalid_amounts(spark, sf_dir):
    return checks.amount_violations(dirty(spark, sf_dir), *AMOUNTS)


@query(
    with_views(
        "dirty_sales",
        f"""select distinct s, q, p from dirty_sales where {INCONSISTENT}
            order by s nulls first, q nulls first, p nulls first""",
    )
)
def sales_distinct_invalid(spark, sf_dir):
    return checks.distinct_amount_violations(dirty(spark, sf_dir), *AMOUNTS)


@query(
    with_views(
        "dirty_sales",
        f"""select {RAW},
                   cast({S} as bigint) as s, cast({Q} as bigint) as q, cast({P} as bigint) as p
            from dirty_sales where {INCONSISTENT}""",
    )
)
def sales_repair_recompute(spark, sf_dir):
    return repair_amounts(dirty(spark, sf_dir), "recompute", *AMOUNTS, keep=LINE)


@query(
    with_views(
        "dirty_sales",
        f"""select {RAW},
                   case when q > 0 and p > 0 then cast(q as bigint) * p end as s,
                   cast(case when q > 0 then q end as bigint) as q,
                   cast(case when p > 0 then p end as bigint) as p
            from dirty_sales""",
    )
)
def sales_repair_trust_inputs(spark, sf_dir):
    return repair_amounts(dirty(spark, sf_dir), "trust_qty_price", *AMOUNTS, keep=LINE)


@query(
    with_views(
        "dirty_sales",
        f"""select {RAW},
                   case when q > 0 and p > 0 then cast(q as bigint) * p end as s,
                   cast(abs(q) as bigint) as q,
                   cast(case when p > 0 then p else abs(s) // nullif(abs(q), 0) end as bigint)
                     as p
            from dirty_sales where {MISSING}""",
    )
)
def sales_repair_business(spark, sf_dir):
    return repair_amounts(dirty(spark, sf_dir), "business", *AMOUNTS, keep=LINE)


@query(
    with_views(
        "dirty_sales",
        f"""select count(*) as rows,
                   cast(count_if(s is null) as bigint) as null_sales,
                   cast(count_if(q is null) as bigint) as null_quantity,
                   cast(count_if(p is null) as bigint) as null_price,
                   cast(count_if(s <= 0) as bigint) as nonpositive_sales,
                   cast(count_if(q <= 0) as bigint) as nonpositive_quantity,
                   cast(count_if(p <= 0) as bigint) as nonpositive_price,
                   cast(count_if(s <> cast(q as bigint) * p) as bigint) as sales_not_product,
                   cast(count_if({INCONSISTENT}) as bigint) as any_violation
            from dirty_sales""",
    )
)
def dq_report(spark, sf_dir):
    return sales_amount_report(dirty(spark, sf_dir), *AMOUNTS)


@query(
    with_views(
        "dirty_sales_dates",
        """select count(*) as rows,
             cast(count_if(sls_order_dt is null) as bigint) as null_sls_order_dt,
             cast(count_if(sls_ship_dt is null) as bigint) as null_sls_ship_dt,
             cast(count_if(sls_due_dt is null) as bigint) as null_sls_due_dt,
             cast(count_if(length(cast(sls_order_dt as varchar)) <> 8) as bigint)
               as not_eight_sls_order_dt,
             cast(count_if(length(cast(sls_ship_dt as varchar)) <> 8) as bigint)
               as not_eight_sls_ship_dt,
             cast(count_if(length(cast(sls_due_dt as varchar)) <> 8) as bigint)
               as not_eight_sls_due_dt,
             cast(count_if(sls_due_dt not between 19990101 and 20300101) as bigint)
               as outside_sls_due_dt,
             cast(count_if(sls_order_dt is null or sls_ship_dt is null or sls_due_dt is null
               or length(cast(sls_order_dt as varchar)) <> 8
               or length(cast(sls_ship_dt as varchar)) <> 8
               or length(cast(sls_due_dt as varchar)) <> 8
               or sls_due_dt not between 19990101 and 20300101) as bigint) as invalid_dates,
             cast(count_if(sls_order_dt > sls_ship_dt or sls_order_dt > sls_due_dt) as bigint)
               as order_after_later
           from dirty_sales_dates""",
    )
)
def dq_report_dates(spark, sf_dir):
    return sales_date_report(view(spark, sf_dir, "dirty_sales_dates"), *DATES)
