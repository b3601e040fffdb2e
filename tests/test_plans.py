"""The physical plans large tables depend on."""

import re

import pytest

from contract.customer_queries import dirty
from siltwork.operators import checks, keys
from siltwork.operators.checks import domain_values
from siltwork.operators.lookups import lookup
from siltwork.operators.ordering import head_sample
from siltwork.operators.skew import SkewPolicy
from siltwork.plans.customers import cleanse_customers
from siltwork.plans.quality import customer_report
from siltwork.session import write_out
from siltwork.sources.staging import stage
from tests.oracle import plan

SF_DIR = "/root/testdata/sf0.01"


def exchanges(text):
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


@pytest.fixture(scope="module")
def customers(spark):
    return write_out(dirty(spark, SF_DIR), "customers")


def test_latest_drops_null_keys_at_the_scan_and_limits_before_the_shuffle(customers):
    text = plan(cleanse_customers(customers, ["src_row"]))
    assert "PushedFilters: [IsNotNull(cst_id)]" in text
    assert text.count("WindowGroupLimit") >= 2 and exchanges(text) == 1
    assert "cst_marital_status" not in text


def test_row_checks_do_not_shuffle(customers):
    for check in (
        checks.whitespace_violations(customers, ["cst_firstname"]),
        checks.date_order_violations(customers, "cst_create_date", ["cst_create_date"]),
    ):
        assert exchanges(plan(check)) == 0


def test_checks_read_only_their_columns(customers):
    text = plan(checks.domain_values(customers, "cst_gndr"))
    assert "ReadSchema: struct<cst_gndr:string>" in text
    text = plan(keys.pk_violations(customers, "cst_id"))
    assert "ReadSchema: struct<cst_id:int>" in text and text.count("HashAggregate") >= 2


def test_report_is_one_scan_and_moves_one_row_per_task(customers):
    text = plan(customer_report(customers))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
    assert text.count("HashAggregate") >= 2


def test_few_repeated_keys_are_broadcast_and_rows_stay_put(spark):
    rows = spark.range(0, 20000).selectExpr("if(id < 10, 0, id) as k", "repeat('x', 20) as v")
    found = keys.duplicate_rows(write_out(rows, "rows"), "k")
    assert len(found.collect()) == 10
    final = plan(found)
    assert "isFinalPlan=true" in final and "BroadcastHashJoin LeftSemi" in final


def test_staging_splits_all_rows_and_restores_the_setting(spark, tmp_path, customers):
    tagged = customers.selectExpr("*", "if(cst_id is null, 'no id', null) as why")
    staged = stage(tagged, "why", str(tmp_path / "staged"))
    assert staged.good_rows().count() == customers.where("cst_id is not null").count()
    assert staged.rejects().count() == customers.where("cst_id is null").count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_lookup_of_a_small_table_is_broadcast_without_counting_keys(spark, customers):
    labels = write_out(
        spark.createDataFrame([("F", "Female"), ("M", "Male")], "cst_gndr string, label string"),
        "labels",
    )
    tracker = spark.sparkContext.statusTracker()
    jobs = len(tracker.getJobIdsForGroup(None))
    joined = lookup(customers, labels, "cst_gndr", SkewPolicy(hot_rows=5))
    assert len(tracker.getJobIdsForGroup(None)) == jobs
    assert "BroadcastHashJoin LeftOuter" in plan(joined)


def test_head_sample_moves_only_the_first_rows(spark, customers):
    for n in (1000, 100_000):
        text = plan(head_sample(customers, ["cst_id", "cst_key"], n, ["cst_key"]))
        assert "TakeOrderedAndProject" in text and "Window" not in text


def test_collated_values_are_made_distinct_by_hash_first(spark, customers):
    text = plan(domain_values(customers, "cst_gndr", "UTF8_LCASE_RTRIM"))
    nodes = re.findall(r"(HashAggregate|SortAggregate|Scan parquet)", text.split("(1)")[0])
    assert nodes[-3:] == ["HashAggregate", "HashAggregate", "Scan parquet"]


def _read(text):
    """Folders, without their random ends, that a plan scans."""
    return {re.sub(r"-[0-9a-f]{12}$", "", x.split("/")[-1]) for x in re.findall(r"Location: \w+ \[file:([^\],]*)", text)}


def test_spread_numbers_come_from_written_rows_only(spark, customers):
    """Neither the halves nor the bounds of ranges compute the input again."""
    hot = SkewPolicy(hot_rows=100)
    text = plan(keys.superseded_rows(customers, "cst_id", "cst_create_date", ["src_row"], skew=hot))
    assert _read(text) <= {"hot-and-ordinary", "numbered", "spans"}


def test_the_value_before_needs_no_join_of_rows_with_themselves(spark, customers):
    hot = SkewPolicy(hot_rows=100)
    found = keys.following_value(
        customers, "cst_id", "cst_create_date", "src_row", "later", ["src_row"], hot
    )
    text = plan(found)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert _read(text) <= {"hot-and-ordinary", "numbered", "spans"}


def test_a_date_check_names_its_value_once(spark):
    from pyspark.sql import functions as F

    from siltwork.functions import dates

    made = spark.range(9).select(F.when(F.col("id") > 3, F.col("id") * 7_654_321).alias("day"))
    checked = made.where(~dates.eight_characters("day"))
    optimized = checked._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in optimized.splitlines() if "Filter" in line)
    assert condition.count("7654321") == 1
