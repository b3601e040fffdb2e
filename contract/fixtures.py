"""Dirty views of the test tables.

The test tables are clean, so dirt is added by rule. The text of each view runs
unchanged in Spark and DuckDB; table names are in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # Raw CRM customers: several versions per key, NULL keys, stray blanks.
    "dirty_customers": """
        select cast(case when o_orderkey % 101 = 0 then null else o_custkey end as int) as cst_id,
               concat('AW', lpad(cast(o_custkey as varchar(20)), 8, '0')) as cst_key,
               case when o_orderkey % 5 = 0 then concat(' ', o_orderpriority)
                    when o_orderkey % 5 = 1 then concat(o_orderpriority, ' ')
                    else o_orderpriority end as cst_firstname,
               case when o_orderkey % 7 = 0 then concat('  ', o_orderstatus)
                    else o_orderstatus end as cst_lastname,
               case o_orderkey % 4 when 0 then 'S' when 1 then 'M' when 2 then ' S'
                    else null end as cst_marital_status,
               case o_orderkey % 6 when 0 then 'F' when 1 then 'M' when 2 then ' f '
                    when 3 then 'm' when 4 then null else 'X' end as cst_gndr,
               cast(o_orderdate as date) as cst_create_date,
               o_orderkey as src_row
        from {orders}""",
    # Raw ERP customers: prefixed keys, some keys in both spellings, implausible birth
    # dates, mixed gender codes.
    "dirty_erp_customers": """
        select case when c_custkey % 3 = 0
                    then concat('NASAW', lpad(cast(c_custkey as varchar(20)), 8, '0'))
                    else concat('AW', lpad(cast(c_custkey as varchar(20)), 8, '0')) end as cid,
               cast(date '1910-01-01' + cast((c_custkey * 37) % 45000 as int) as date) as bdate,
               case c_custkey % 8 when 0 then 'F' when 1 then 'Female' when 2 then 'M'
                    when 3 then 'Male' when 4 then ' f' when 5 then 'MALE '
                    when 6 then null else '' end as gen
        from {customer}
        union all
        select concat('AW', lpad(cast(c_custkey as varchar(20)), 8, '0')),
               cast(date '1960-01-01' + cast((c_custkey * 7) % 9000 as int) as date), 'm'
        from {customer} where c_custkey % 15 = 0""",
    # Sales dates as integers: missing, zero, too short, far out.
    "dirty_sales_dates": """
        select l_orderkey, l_linenumber,
               cast(case when l_orderkey % 31 = 0 then null when l_orderkey % 37 = 0 then 0
                         when l_orderkey % 41 = 0 then 5489
                         else year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate)
                    end as int) as sls_order_dt,
               cast(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as int)
                    as sls_ship_dt,
               cast(case when l_partkey % 43 = 0 then 20990101 when l_partkey % 47 = 0 then 19800101
                         else year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate)
                    end as int) as sls_due_dt
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    # Sales amounts: missing, negative, zero, inconsistent.
    "dirty_sales": """
        select l_orderkey, l_linenumber, cast(l_shipdate as date) as sd,
               cast(case when (l_orderkey+l_linenumber) % 13 = 0 then null
                         when (l_orderkey+l_linenumber) % 17 = 0 then -l_quantity
                         when (l_orderkey+l_linenumber) % 19 = 0 then 0
                         else l_quantity end as int) as q,
               cast(case when (l_partkey+l_linenumber) % 11 = 0 then null
                         when (l_partkey+l_linenumber) % 23 = 0
                              then -floor(l_extendedprice/l_quantity)
                         when (l_partkey+l_linenumber) % 29 = 0 then 0
                         else floor(l_extendedprice/l_quantity) end as int) as p,
               cast(case when l_suppkey % 7 = 0 then null
                         when l_suppkey % 9 = 0 then -floor(l_extendedprice)
                         when l_suppkey % 10 = 0 then floor(l_extendedprice)+1
                         else floor(l_extendedprice/l_quantity)*l_quantity end as int) as s
        from {lineitem}""",
    # Raw products: three versions per key, some starting together, some under a second
    # category; ends before starts, padded line codes.
    "dirty_products": """
        select cast(p_partkey as int) as prd_id,
               concat(case when p_partkey % 39 = 2 then 'ZZ'
                           when cast(floor(p_partkey / 3) as int) % 4 = 0 then 'AC'
                           when cast(floor(p_partkey / 3) as int) % 4 = 1 then 'BI'
                           when cast(floor(p_partkey / 3) as int) % 4 = 2 then 'CL'
                           else 'CO' end,
                      '-',
                      lpad(cast(cast(floor(p_partkey / 3) as int) % 30 as varchar(20)), 2, '0'),
                      '-P',
                      lpad(cast(cast(floor(p_partkey / 3) as int) as varchar(20)), 8, '0'))
                    as prd_key,
               concat(p_name, ' ', p_brand) as prd_nm,
               cast(case when p_partkey % 50 = 0 then null else floor(p_retailprice) end as int)
                    as prd_cost,
               case p_partkey % 5 when 0 then 'R ' when 1 then 'M ' when 2 then 'S '
                    when 3 then 'T ' else null end as prd_line,
               cast(date '2003-07-01'
                    + cast(((p_partkey - case when p_partkey % 21 = 1 then 1 else 0 end) * 17)
                           % 3650 as int) as date) as prd_start_dt,
               case when p_partkey % 2 = 0 then null
                    else cast(date '2003-07-01'
                              + cast((p_partkey * 17) % 3650 - 400 as int) as date)
                    end as prd_end_dt
        from {part}""",
    # Categories of those products; some ids are spelled so that no product finds them.
    "dirty_categories": """
        select case when n % 11 = 5 then concat('XX_', lpad(cast(n as varchar(20)), 2, '0'))
                    else concat(case g when 0 then 'AC' when 1 then 'BI' when 2 then 'CL'
                                else 'CO' end, '_', lpad(cast(n as varchar(20)), 2, '0')) end as id,
               case g when 0 then 'Accessories' when 1 then 'Bikes' when 2 then 'Clothing'
                    else 'Components' end as cat,
               concat('Group ', cast(n as varchar(20))) as subcat,
               case when n % 2 = 0 then 'Yes' else 'No' end as maintenance
        from (select distinct cast(floor(p_partkey / 3) as int) % 4 as g,
                     cast(floor(p_partkey / 3) as int) % 30 as n from {part}) as groups""",
    "dirty_locations": """
        select concat('AW', lpad(cast(c_custkey as varchar(20)), 8, '0')) as cid,
               case when c_custkey % 6 = 0 then concat(n_name, ' ')
                    when c_custkey % 17 = 0 then null else n_name end as cntry
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    # Raw sales with keys, integer dates and amounts.
    "dirty_crm_sales": """
        select concat('SO', cast(l_orderkey as varchar(20)), '-',
                      cast(l_linenumber as varchar(20))) as sls_ord_num,
               concat('P', lpad(cast(cast(floor(l_partkey / 3) as int) as varchar(20)), 8, '0'))
                    as sls_prd_key,
               cast(case when l_orderkey % 53 = 0 then null else o_custkey end as int)
                    as sls_cust_id,
               cast(case when l_orderkey % 31 = 0 then null when l_orderkey % 37 = 0 then 0
                         when l_orderkey % 41 = 0 then 20100232
                         else year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate)
                    end as int) as sls_order_dt,
               cast(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as int)
                    as sls_ship_dt,
               cast(case when l_partkey % 43 = 0 then 5489
                         else year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate)
                    end as int) as sls_due_dt,
               cast(case when l_suppkey % 7 = 0 then null
                         when l_suppkey % 9 = 0 then -floor(l_extendedprice)
                         when l_suppkey % 10 = 0 then floor(l_extendedprice)+1
                         else floor(l_extendedprice/l_quantity)*l_quantity end as int) as sls_sales,
               cast(case when (l_orderkey+l_linenumber) % 13 = 0 then null
                         when (l_orderkey+l_linenumber) % 17 = 0 then -l_quantity
                         else l_quantity end as int) as sls_quantity,
               cast(case when (l_partkey+l_linenumber) % 11 = 0 then null
                         when (l_partkey+l_linenumber) % 23 = 0
                              then -floor(l_extendedprice/l_quantity)
                         else floor(l_extendedprice/l_quantity) end as int) as sls_price
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    # Lines of an extract: half of them broken in one of four ways, some blank, some quoted.
    "extract_lines": """
        select case c_custkey % 10
                    when 0 then concat(cid, ',', born, ',M,extra')
                    when 1 then concat(cid, ',1975-13-01,M')
                    when 2 then concat(cid, ',', born)
                    when 3 then concat(cid, ',', born, ',', repeat('x', 51))
                    when 4 then concat('"', cid, ',', born, ',M"')
                    when 5 then concat(cid, ',,')
                    else case c_custkey % 40 when 6 then ' ' when 7 then '   '
                         else concat(cid, ',', born, ', m ') end end as line,
               c_custkey % 10 < 4 or c_custkey % 40 in (6, 7) as broken,
               case when c_custkey % 10 = 4 then concat('"', cid) else cid end as cid,
               case when c_custkey % 10 = 5 then null else cast(born as date) end as bdate,
               case c_custkey % 10 when 4 then 'M"' when 5 then null else ' m ' end as gen
        from (select c_custkey, concat('AW', cast(c_custkey as varchar(20))) as cid,
                     cast(cast(date '1930-01-01' + cast(c_custkey % 20000 as int) as date)
                          as varchar(20)) as born
              from {customer}) as people""",
}

_TABLE = re.compile(r"{(\w+)}")


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the tables in ``sf_dir``."""
    tables = sorted(set(_TABLE.findall(VIEWS[name])))
    return spark.sql(VIEWS[name], **{t: base(spark, sf_dir, t) for t in tables})


def with_views(names: str, query: str) -> str:
    """``query`` as SQL text that defines the views it reads."""
    definitions = [f"{n} as ({_TABLE.sub(lambda m: m[1], VIEWS[n])})" for n in names.split()]
    return f"with {', '.join(definitions)}\n{query}"
