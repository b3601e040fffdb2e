"""Ingest, refresh, audit, constraints, and the layered load."""

import datetime as dt
import gzip
import threading
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.load_queries import BRONZE_VIEWS, OPTIONS, bronze, extract
from siltwork.operators import constraints, keys
from siltwork.operators.lineage import stamp_lineage
from siltwork.operators.skew import SkewPolicy
from siltwork.plans import profiles
from siltwork.plans.bronze import load_bronze
from siltwork.plans.gold import load_gold
from siltwork.plans.load_job import (
    ALL_TABLES,
    Loaded,
    LoadFailed,
    _with_seconds,
    read_audit,
    run_batch,
)
from siltwork.plans.silver import SilverOptions, load_silver, silver_rows
from siltwork.schemas import LINEAGE_COLUMNS, SPECS, TABLES
from siltwork.session import scratch_path, shared_folder
from siltwork.sources.delimited import BAD_LINE, read_delimited, stage_delimited
from siltwork.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"
EDGE = (
    "id,k,n,d,ts\r\n"
    "1,abc,R ,2003-07-01,2003-07-01\r\n"
    ",x,,,\r\n"
    'bad,"q,z,2003-07-01,\r\n'
    '4,toolong,"a",2003-13-01,2003-07-01\r\n'
    "6,short\r\n"
    "7,a,b,,,extra\r\n"
    "5,e,f,,2003-07-01"
)
EDGE_SCHEMA = "id int, k string, n string, d date, ts timestamp_ntz"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), f"t{abs(hash(str(tmp_path)))}_")


def save(path, text):
    path.write_bytes(text.encode())
    return str(path)


def customers(lines, bad=0):
    rows = [f"AW{i},2000-01-01,M" for i in range(lines)] + [f"AW{i},no date,M" for i in range(bad)]
    return "\r\n".join(["CID,BDATE,GEN", *rows])


def test_edge_cases_of_delimited_files(spark, tmp_path):
    path = save(tmp_path / "edge.csv", EDGE)
    staged = stage_delimited(
        spark, path, T.StructType.fromDDL(EDGE_SCHEMA), scratch_path(spark, "t")
    )
    midnight, day = dt.datetime(2003, 7, 1), dt.date(2003, 7, 1)
    assert {tuple(r) for r in staged.good_rows().collect()} == {
        (1, "abc", "R ", day, midnight),
        (None, "x", None, None, None),
        (5, "e", "f", None, midnight),
    }
    assert {r[BAD_LINE].split(",")[0] for r in staged.rejects().collect()} == {"bad", "4", "6", "7"}
    assert {r.n for r in staged.rejects().where("id = 4").collect()} == {'"a"'}


def test_columns_bind_by_position_and_every_file_has_a_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        save(folder / f"{i}.csv", f"other,names\r\n{i},x")
    rows = read_delimited(spark, str(folder), T.StructType.fromDDL("id int, k string"))
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2]


def test_fields_longer_than_declared_are_bad(spark, tmp_path):
    path = save(tmp_path / "long.csv", "a,b\r\nxxx,1\r\nxxxx,2\r\n,3")
    schema = T.StructType.fromDDL("a varchar(3), b int")
    staged = stage_delimited(spark, path, schema, scratch_path(spark, "t"))
    assert [r[BAD_LINE] for r in staged.rejects().collect()] == ["xxxx,2"]
    assert staged.good_rows().count() == 2


def test_refresh_replaces_and_a_failed_load_keeps_the_old_rows(warehouse, tmp_path):
    def load(batch, text, **options):
        path = save(tmp_path / f"{batch}.csv", text)
        return load_bronze(warehouse, {"erp_cust_az12": path}, batch, **options)

    load(1, customers(3))
    assert warehouse.rejects("bronze", "erp_cust_az12").isEmpty()
    load(2, customers(5, bad=10))
    bad = warehouse.rejects("bronze", "erp_cust_az12")
    assert {r[BAD_LINE] for r in bad.collect()} == {f"AW{i},no date,M" for i in range(10)}
    table = warehouse.table("bronze", "erp_cust_az12")
    assert table.count() == 5
    with pytest.raises(LoadFailed, match="11 bad lines, limit 10"):
        load(3, customers(9, bad=11))
    assert warehouse.table("bronze", "erp_cust_az12").count() == 5
    load(4, customers(9, bad=11), max_rejects=11)
    assert warehouse.table("bronze", "erp_cust_az12").count() == 9
    assert len(warehouse.remove_old_batches("bronze", "erp_cust_az12")) == 3
    assert warehouse.table("bronze", "erp_cust_az12").count() == 9
    audit = read_audit(warehouse).where(F.col("table_name") != ALL_TABLES)
    assert {(r.batch_id, r.status, r.rows, r.rejects) for r in audit.collect()} == {
        (1, "SUCCEEDED", 3, 0),
        (2, "SUCCEEDED", 5, 10),
        (3, "FAILED", None, None),
        (4, "SUCCEEDED", 9, 11),
    }


def test_failure_skips_later_tables_and_is_recorded(warehouse, tmp_path):
    extracts = {
        "erp_px_cat_g1v2": save(tmp_path / "c.csv", "ID,CAT,SUBCAT,MAINTENANCE\r\nA,B,C,D"),
        "erp_cust_az12": str(tmp_path / "missing.csv"),
        "crm_cust_info": save(tmp_path / "k.csv", "a,b,c,d,e,f,g\r\n1,k, f ,l,S,M,2020-01-01"),
    }
    audit = load_bronze(warehouse, extracts, 1, on_error="record").collect()
    assert [(r.table_name, r.status) for r in audit] == [
        ("crm_cust_info", "SUCCEEDED"),
        ("erp_cust_az12", "FAILED"),
        ("erp_px_cat_g1v2", "SKIPPED"),
        (ALL_TABLES, "FAILED"),
    ]
    failed = audit[1]
    assert failed.error_condition == "PATH_NOT_FOUND" and failed.sql_state == "42K03"
    assert "missing.csv" in failed.error
    assert warehouse.table("bronze", "crm_cust_info").first().cst_firstname == " f "
    with pytest.raises(LoadFailed):
        load_bronze(warehouse, extracts, 2)
    with pytest.raises(ValueError, match="unknown tables"):
        load_bronze(warehouse, {"nope": "x"}, 3)
    with pytest.raises(ValueError, match="on_error"):
        load_bronze(warehouse, extracts, 3, on_error="ignore")


def test_seconds_count_boundaries(spark):
    start, end = dt.datetime(2026, 1, 1, 0, 0, 0, 900000), dt.datetime(2026, 1, 1, 0, 0, 1, 100000)
    df = spark.createDataFrame([(start, end)], "started timestamp_ntz, ended timestamp_ntz")
    assert _with_seconds(df).first().seconds == 1


def test_reset_needs_confirmation_and_empties_everything(warehouse, tmp_path, spark):
    path = save(tmp_path / "a.csv", customers(3))
    load_bronze(warehouse, {"erp_cust_az12": path}, 1)
    with pytest.raises(ValueError, match="confirm"):
        warehouse.reset()
    assert warehouse.table("bronze", "erp_cust_az12").count() == 3
    warehouse.reset(confirm=True)
    with pytest.raises(AnalysisException):
        warehouse.table("bronze", "erp_cust_az12").count()
    assert not os.path.exists(f"{warehouse.layer_path('bronze')}/erp_cust_az12")
    databases = {d.name for d in spark.catalog.listDatabases()}
    assert {warehouse.database(layer) for layer in ("bronze", "silver", "gold")} <= databases


def test_tables_are_created_as_declared_and_recreated_empty(warehouse, spark):
    warehouse.create_layers()
    for layer in ("bronze", "silver"):
        warehouse.recreate_tables(layer)
        warehouse.recreate_tables(layer)
        for table in TABLES:
            frame = warehouse.table(layer, table)
            assert frame.count() == 0
            own = frame.select([c for c in frame.columns if c not in LINEAGE_COLUMNS])
            declared = SPECS[table].readable(layer)
            assert own.dtypes == [(f.name, f.dataType.simpleString()) for f in declared]
    name = warehouse.table_name("silver", "erp_loc_a101")
    spark.sql(f"insert into {name} (cid, cntry) values ('AW1', 'here')")
    assert spark.table(name).first().dwh_load_datetime is not None
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"insert into {name} (cid) values ('{'x' * 51}')")


def test_constraints_name_every_broken_rule(spark):
    df = spark.createDataFrame([(1, "ab"), (None, "abc"), (2, None)], "id int, k string")
    rules = constraints.null_rules(["id"]) | constraints.length_rules({"k": 2})
    tagged = constraints.tag_violations(df, rules)
    assert constraints.accepted(tagged).count() == 2
    found = constraints.quarantined(tagged).collect()
    assert [r.violations for r in found] == ["id is null; k longer than 2"]
    assert constraints.accepted(constraints.tag_violations(df, {})).count() == 3


def test_values_that_do_not_fit_are_quarantined_not_fatal(spark):
    rows = [("SO1", "P", 1, 20200101, 20200101, 20200101, None, 2_000_000_000, 2_000_000_000)]
    raw = spark.createDataFrame(rows, SPECS["crm_sales_details"].readable("bronze"))
    row = silver_rows("crm_sales_details", raw, OPTIONS).first()
    assert row.violations == "sls_sales does not fit decimal(18,2)"


def test_lineage_is_one_value_per_batch(spark):
    at = dt.datetime(2026, 1, 1, 1, 2, 3, 456)
    row = stamp_lineage(spark.range(1), at, None, 3).first()
    assert (row.dwh_load_datetime, row.dwh_source_system, row.dwh_batch_id) == (at, None, 3)


def test_products_split_keys_and_end_before_the_next_version(spark):
    start = [dt.datetime(2011, 7, 1), dt.datetime(2012, 7, 1)]
    rows = [
        (i, "AC-HE-HL-U509-R", "Helmet", 12, "S ", s, dt.datetime(2007, 1, 1))
        for i, s in enumerate(start)
    ]
    raw = spark.createDataFrame(rows, SPECS["crm_prd_info"].readable("bronze"))
    got = silver_rows("crm_prd_info", raw, SilverOptions(dt.date(2026, 1, 1))).collect()
    assert {(r.prd_id, r.cat_id, r.prd_key, r.prd_line, r.prd_end_dt) for r in got} == {
        (0, "AC_HE", "HL-U509-R", "S", dt.date(2012, 6, 30)),
        (1, "AC_HE", "HL-U509-R", "S", None),
    }


def test_whole_load_from_extracts_to_gold(spark, warehouse):
    load_bronze(warehouse, {t: extract(spark, SF_DIR, t) for t in BRONZE_VIEWS}, 1)
    audit = load_silver(warehouse, 2, OPTIONS)
    assert [r.table_name for r in audit.collect()] == [*TABLES, ALL_TABLES]
    for table in TABLES:
        rows = warehouse.table("silver", table)
        assert rows.select(*LINEAGE_COLUMNS[1:]).distinct().collect() == [
            (SPECS[table].source_system, 2)
        ]
        assert rows.select("dwh_load_datetime").distinct().count() == 1
    kept = {r.table_name: (r.rows, r.rejects) for r in audit.collect()}
    for table in ("crm_sales_details", "erp_loc_a101"):
        assert sum(kept[table]) == bronze(spark, SF_DIR, table).count()
    load_gold(warehouse, 3)
    facts = warehouse.table("gold", "fact_sales")
    assert facts.count() == warehouse.table("silver", "crm_sales_details").count()
    assert warehouse.table("gold", "dim_customers").count() == kept["crm_cust_info"][0]


def test_profiles_agree_with_the_operators_and_each_other(spark):
    day = dt.date(2026, 1, 1)
    rows = bronze(spark, SF_DIR, "crm_cust_info")
    found = profiles.customer_checks(rows)
    report = found["report"].first()
    assert report.rows == rows.count()
    assert found["latest"].count() == found["cleansed"].count()
    assert report.blanks_cst_firstname == found["blanks_firstname"].count()
    assert found["superseded"].count() + found["latest"].count() + 1 == report.rows
    sales = profiles.sales_checks(bronze(spark, SF_DIR, "crm_sales_details"))
    assert sales["amount_report"].first().any_violation == sales["invalid_amounts"].count()
    assert sales["repair_recompute"].count() == sales["invalid_amounts"].count()
    assert sales["date_report"].first().invalid_dates == sales["invalid_dates"].count()
    assert sales["date_report"].first().order_after_later == sales["date_order"].count()
    erp = profiles.erp_customer_checks(bronze(spark, SF_DIR, "erp_cust_az12"), day)
    assert erp["gender_mapping"].count() == erp["gender_values"].count()
    for checked in (*found.values(), *sales.values(), *erp.values()):
        checked.write.format("noop").mode("overwrite").save()


def test_tables_with_declared_lengths_take_the_spreading_plans(spark, warehouse):
    load_bronze(warehouse, {"crm_cust_info": extract(spark, SF_DIR, "crm_cust_info")}, 1)
    table = warehouse.table("bronze", "crm_cust_info")
    skew = SkewPolicy(hot_rows=10)
    for key in ("cst_id", "cst_key", "cst_marital_status"):
        for operator in (keys.number_rows, keys.ranked_duplicates):
            plain = operator(table, key, "cst_create_date")
            spread = operator(table, key, "cst_create_date", skew=skew)
            assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
        assert (
            keys.duplicate_rows(table, key, skew=skew).count()
            == keys.duplicate_rows(table, key).count()
        )


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class ClusterWithoutSetting:
    """Just enough of a session to ask where its shared folder is."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app-1"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(ClusterWithoutSetting)


def test_every_line_is_accepted_or_rejected(spark, tmp_path):
    lines = ["1,a", "", "   ", "2,b", "x,c", "\t", "3"]
    path = save(tmp_path / "blank.csv", "\r\n".join(["id,k", *lines]) + "\r\n")
    staged = stage_delimited(
        spark, path, T.StructType.fromDDL("id int, k string"), scratch_path(spark, "t")
    )
    assert staged.good_rows().count() == 2
    assert {r[BAD_LINE] for r in staged.rejects().collect()} == {"", "   ", "\t", "x,c", "3"}


def test_rejects_of_an_empty_extract_are_none(warehouse, tmp_path):
    load_bronze(warehouse, {"erp_cust_az12": save(tmp_path / "none.csv", "CID,BDATE,GEN")}, 1)
    assert warehouse.table("bronze", "erp_cust_az12").count() == 0
    assert warehouse.rejects("bronze", "erp_cust_az12").count() == 0


def test_a_load_whose_count_fails_keeps_the_old_rows(warehouse, tmp_path, monkeypatch):
    load_bronze(warehouse, {"erp_cust_az12": save(tmp_path / "a.csv", customers(3))}, 1)

    def fails(*args):
        raise RuntimeError("no count")

    monkeypatch.setattr("siltwork.sources.staging.write_counted", fails)
    again = {"erp_cust_az12": save(tmp_path / "b.csv", customers(9))}
    audit = load_bronze(warehouse, again, 2, on_error="record")
    assert {r.status for r in audit.collect()} == {"FAILED"}
    assert warehouse.table("bronze", "erp_cust_az12").count() == 3


def test_a_load_reads_each_extract_once_and_counts_while_writing(spark, tmp_path):
    """One job with one scan of the text; none after it."""
    path = save(tmp_path / "a.csv", customers(300, bad=3))
    schema = SPECS["erp_cust_az12"].declared("bronze")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    staged = stage_delimited(spark, path, schema, scratch_path(spark, "t"))
    assert (staged.rows, staged.rejected) == (300, 3)
    assert len(set(tracker.getJobIdsForGroup(None)) - before) == 1
    assert (staged.good_rows().count(), staged.rejects().count()) == (300, 3)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "512m"


def test_rejects_stand_as_in_the_file(spark, tmp_path):
    """Also lines whose values would be written in another way, and lines like the header."""
    lines = ["007,abcd,x", "+1,abcd,", " 5,a,b", "1,ok,y", "id,k,n", "id,k,n", "02,ok,", "1,\"a,\""]
    path = save(tmp_path / "odd.csv", "\r\n".join(["\t", "id,k,n", *lines]))
    schema = T.StructType.fromDDL("id int, k varchar(3), n string")
    staged = stage_delimited(spark, path, schema, scratch_path(spark, "t"))
    bad = sorted(r[BAD_LINE] for r in staged.rejects().collect())
    assert bad == sorted(["\t", "007,abcd,x", "+1,abcd,", " 5,a,b", "id,k,n", "id,k,n"])
    assert {tuple(r) for r in staged.good_rows().collect()} == {
        (1, "ok", "y"), (2, "ok", None), (1, '"a', '"')
    }
    assert (staged.rows, staged.rejected) == (3, 6)


def test_each_file_loses_its_own_header_only(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    save(folder / "a.csv", "a,b\r\n1,x\r\nc,d\r\n")
    save(folder / "b.csv", "c,d\n2,y\na,b\n")
    save(folder / "c.csv", "")
    (folder / "d.csv.gz").write_bytes(gzip.compress(b"c,d\n3,z"))
    schema = T.StructType.fromDDL("k string, v string")
    staged = stage_delimited(spark, str(folder), schema, scratch_path(spark, "t"))
    assert sorted(tuple(r) for r in staged.good_rows().collect()) == [
        ("1", "x"), ("2", "y"), ("3", "z"), ("a", "b"), ("c", "d")
    ]
    assert (staged.rows, staged.rejected) == (5, 0)


def test_header_is_checked_on_demand(spark, warehouse, tmp_path):
    right = {"erp_cust_az12": save(tmp_path / "a.csv", customers(2))}
    wrong = {"erp_cust_az12": save(tmp_path / "b.csv", customers(2).replace("BDATE", "BORN"))}
    load_bronze(warehouse, right, 1, check_header=True)
    load_bronze(warehouse, wrong, 2)
    with pytest.raises(LoadFailed, match="is headed 'CID,BORN,GEN', not 'cid,bdate,gen'"):
        load_bronze(warehouse, wrong, 3, check_header=True)
    schema = T.StructType.fromDDL("cid string, bdate date, gen string")
    assert read_delimited(spark, right["erp_cust_az12"], schema, check_header=True).count() == 2
    with pytest.raises(Exception, match="CSV header"):
        read_delimited(spark, wrong["erp_cust_az12"], schema, check_header=True).collect()


def test_a_batch_is_seen_whole(warehouse, tmp_path, monkeypatch):
    """A reader between two tables' catalog updates sees all old or all new rows."""
    def extracts(n):
        places = "\n".join(["CID,CNTRY", *[f"AW{i},DE" for i in range(n)]])
        return {
            "erp_loc_a101": save(tmp_path / f"l{n}.csv", places),
            "erp_cust_az12": save(tmp_path / f"c{n}.csv", customers(n)),
        }

    assert warehouse.snapshot("bronze") == {}
    load_bronze(warehouse, extracts(3), 1, whole=True)
    seen = []

    def counts():
        return {t: df.count() for t, df in warehouse.snapshot("bronze").items()}

    points = Warehouse._point

    def watched(self, *args):
        seen.append(counts())
        points(self, *args)
        seen.append(counts())

    monkeypatch.setattr(Warehouse, "_point", watched)
    old = warehouse.snapshot("bronze")
    load_bronze(warehouse, extracts(5), 2, whole=True, at_once=2)
    assert seen == [{"erp_loc_a101": 5, "erp_cust_az12": 5}] * 4
    assert {df.count() for df in old.values()} == {3}
    assert warehouse.table("bronze", "erp_loc_a101").count() == 5

    bad = extracts(7) | {"erp_cust_az12": save(tmp_path / "bad.csv", customers(7, bad=11))}
    audit = load_bronze(warehouse, bad, 3, on_error="record", whole=True).collect()
    assert [r.status for r in audit] == ["WITHHELD", "FAILED", "FAILED"]
    assert counts() == {"erp_loc_a101": 5, "erp_cust_az12": 5}
    assert warehouse.table("bronze", "erp_loc_a101").count() == 5


def test_a_recreated_table_leaves_the_snapshot(warehouse, tmp_path):
    load_bronze(warehouse, {"erp_cust_az12": save(tmp_path / "a.csv", customers(3))}, 1)
    warehouse.recreate_table("bronze", "erp_cust_az12")
    assert warehouse.snapshot("bronze") == {}
    load_bronze(warehouse, {"erp_cust_az12": save(tmp_path / "b.csv", customers(4))}, 2)
    assert warehouse.snapshot("bronze")["erp_cust_az12"].count() == 4
    warehouse.reset(confirm=True)
    assert warehouse.snapshot("bronze") == {}


def test_two_loads_cannot_publish_one_manifest(warehouse, tmp_path):
    load_bronze(warehouse, {"erp_cust_az12": save(tmp_path / "a.csv", customers(3))}, 1)
    version, batches = warehouse._manifest("bronze")
    with pytest.raises(RuntimeError, match="at the same time"):
        warehouse._write_manifest("bronze", version, {})
    assert warehouse._manifest("bronze") == (version, batches)


def test_tables_load_at_the_same_time_in_unchanged_order(warehouse):
    """Each of two loads waits for the other; the third runs though it will be skipped."""
    together = threading.Barrier(2, timeout=60)

    def meeting(fail=False):
        together.wait()
        if fail:
            raise ValueError("second")
        path = scratch_path(warehouse.spark, "t")
        warehouse.spark.createDataFrame([("A", "DE")], "cid string, cntry string").write.parquet(path)
        return Loaded(1, 0, path)

    warehouse.create_layers()
    loads = {
        "erp_loc_a101": meeting,
        "erp_cust_az12": lambda: meeting(fail=True),
        "erp_px_cat_g1v2": lambda: Loaded(0, 0, "nowhere"),
    }
    audit = run_batch(warehouse, "bronze", 1, loads, on_error="record", at_once=2).collect()
    assert [(r.table_name, r.status) for r in audit] == [
        ("erp_loc_a101", "SUCCEEDED"),
        ("erp_cust_az12", "FAILED"),
        ("erp_px_cat_g1v2", "SKIPPED"),
        (ALL_TABLES, "FAILED"),
    ]
    assert set(warehouse.snapshot("bronze")) == {"erp_loc_a101"}


def test_versions_that_start_together_end_together(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [(i, "AC-01-X", "n", 1, "R", start, None) for i, start in enumerate(
        [day, day, day + dt.timedelta(days=10), None])]
    df = spark.createDataFrame(rows, SPECS["crm_prd_info"].readable("bronze"))
    got = {r.prd_id: (r.prd_start_dt, r.prd_end_dt) for r in
           silver_rows("crm_prd_info", df, OPTIONS).collect()}
    ends = dt.date(2020, 1, 10)
    assert got[0] == got[1] == (day.date(), ends)
    assert got[2][1] is None


def test_lookup_tables_give_one_row_per_key(spark):
    from siltwork.operators.lookups import one_per_key

    rows = [("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), (None, 9, "z"), ("m", None, None)]
    df = spark.createDataFrame(rows, "k string, n int, s string")
    got = {tuple(r) for r in one_per_key(df, "k", ["n"]).collect()}
    assert got == {("k", 2, "b"), ("m", None, None)}
