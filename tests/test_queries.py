"""Every registered query against its SQL, at the scale of the driver's check."""

import os
from collections import Counter

import pytest

import __spark_entry__ as contract
from contract.registry import QUERIES
from tests.oracle import connect, duck_rows, plan, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert all(q.sql for q in QUERIES.values())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns, rows = spark_rows(result)
    expected_columns, expected = duck_rows(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) > 0
    wrong, lacking = Counter(rows) - Counter(expected), Counter(expected) - Counter(rows)
    assert (sum(wrong.values()), sum(lacking.values())) == (0, 0), (
        f"{columns}\nwrong: {list(wrong)[:5]}\nlacking: {list(lacking)[:5]}"
    )
    text = plan(result)
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF", "InPandas"):
        assert node not in text


def test_entry(spark):
    assert contract.entry(spark).count() > 0
