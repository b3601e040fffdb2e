"""ERP customer checks and cleansing."""

from __future__ import annotations

import datetime as dt

from contract.fixtures import view, with_views
from contract.registry import query
from contract.values import label
from siltwork.functions import codes
from siltwork.operators import checks
from siltwork.plans.quality import erp_customer_report

AS_OF = dt.date(2026, 1, 1)
LABEL = label("gen", codes.GENDER_CODES_AND_WORDS)
OUTSIDE = "bdate not between date '1924-01-01' and date '2026-01-01'"


def dirty(spark, sf_dir):
    return view(spark, sf_dir, "dirty_erp_customers")


@query(
    with_views(
        "dirty_erp_customers", f"select cid, gen, {LABEL} as clean_gen from dirty_erp_customers"
    )
)
def gender_standardize_in(spark, sf_dir):
    label = codes.map_codes("gen", codes.GENDER_CODES_AND_WORDS)
    return dirty(spark, sf_dir).select("cid", "gen", label.alias("clean_gen"))


@query(
    with_views(
        "dirty_erp_customers",
        f"select distinct gen, {LABEL} as clean_gen from dirty_erp_customers",
    )
)
def gender_mapping_preview(spark, sf_dir):
    return checks.mapping_preview(
        dirty(spark, sf_dir), "gen", codes.GENDER_CODES_AND_WORDS, "clean_gen"
    )


@query(with_views("dirty_erp_customers", "select distinct gen from dirty_erp_customers"))
def domain_values_gen(spark, sf_dir):
    return checks.domain_values(dirty(spark, sf_dir), "gen")


@query(
    with_views(
        "dirty_erp_customers",
        r"select cid, regexp_replace(cid, '^NAS', '') as clean_cid from dirty_erp_customers",
    )
)
def strip_key_prefix(spark, sf_dir):
    return dirty(spark, sf_dir).select("cid", codes.strip_prefix("cid").alias("clean_cid"))


@query(
    with_views(
        "dirty_erp_customers", f"select distinct bdate from dirty_erp_customers where {OUTSIDE}"
    )
)
def bdate_out_of_range(spark, sf_dir):
    return checks.date_out_of_range(dirty(spark, sf_dir), "bdate", AS_OF)


@query(
    with_views(
        "dirty_erp_customers",
        f"""select count(*) as rows, cast(count_if(cid is null) as bigint) as null_cid,
                   cast(count_if(starts_with(cid, 'NAS')) as bigint) as prefixed_cid,
                   cast(count_if(gen <> trim(gen)) as bigint) as blanks_gen,
                   cast(count_if({OUTSIDE}) as bigint) as bdate_out_of_range
            from dirty_erp_customers""",
    )
)
def dq_report_erp(spark, sf_dir):
    return erp_customer_report(dirty(spark, sf_dir), AS_OF)
