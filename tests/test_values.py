"""Value semantics that decide results: blanks, NULLs, codes, integer arithmetic."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltwork.functions import codes, dates, text
from siltwork.operators import checks
from siltwork.operators.repair import repair_amounts


def values(df):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.collect()]


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i,) for i in items], f"x {kind}").coalesce(1)


def test_codes_ignore_case_and_blanks_and_default_the_rest(spark):
    df = column(spark, ["F", " f ", "m", "M\t", "", " ", None, "X", "FEMALE"])
    assert values(df.select(codes.map_codes("x", codes.GENDER_CODES))) == [
        "Female", "Female", "Male", "N/A", "N/A", "N/A", "N/A", "N/A", "N/A",
    ]
    words = df.select(codes.map_codes("x", codes.GENDER_CODES_AND_WORDS))
    assert values(words)[-1] == "Female"


def test_mapping_without_labels_gives_the_default(spark):
    assert values(column(spark, ["a"]).select(codes.map_codes("x", {}))) == ["N/A"]


def test_prefix_is_stripped_once_and_only_in_front(spark):
    df = column(spark, ["NASAW00011000", "AWNAS1", "NAS", "nasx", None, "NASNASx"])
    assert values(df.select(codes.strip_prefix("x"))) == [
        "AW00011000", "AWNAS1", "", "nasx", None, "NASx",
    ]


def test_stray_blanks_binary_and_padded(spark):
    df = column(spark, ["ab ", " ab", "ab", "ab\t", None, ""])
    assert values(df.select(text.has_stray_blanks("x"))) == [True, True, False, False, None, False]
    padded = df.select(text.has_stray_blanks("x", text.PADDED))
    assert values(padded) == [False, True, False, False, None, False]


def test_domain_under_collation_shows_one_spelling(spark):
    df = column(spark, ["M", "m", "M ", "F", None])
    assert len(values(checks.domain_values(df, "x"))) == 5
    same = values(checks.domain_values(df, "x", text.PADDED_ANY_CASE))
    assert sorted(same, key=str) == ["F", "M", None]


def test_int_dates(spark):
    numbers = [20100228, 20100232, 0, 5489, None, 20240229, 20230229, -2010011, 201001011]
    df = column(spark, numbers, "int")
    assert values(df.select(dates.int_to_date("x"))) == [
        dt.date(2010, 2, 28), None, None, None, None, dt.date(2024, 2, 29), None, None, None,
    ]


def test_invalid_int_dates_bounds_are_exclusive_and_calendar_is_not_checked(spark):
    rows = [
        (1, 20100232, 20100101, 20300101),  # no calendar date, but eight digits
        (2, 20100101, 20100101, 20300102),
        (3, 20100101, 20100101, 19990101),
        (4, 20100101, 20100101, 19981231),
        (5, None, 20100101, 20100101),
        (6, 20100101, 5489, 20100101),
        (7, 19800101, 20990101, 20100101),  # bounds hold for the last column only
        (8, 20100101, 20100101, None),
        (9, -2010010, 20100101, 20100101),  # the sign counts as a character
    ]
    df = spark.createDataFrame(rows, "id int, o int, s int, d int")
    found = checks.invalid_int_dates(df, ["o", "s", "d"], ["d"])
    assert sorted(r.id for r in found.collect()) == [2, 4, 5, 6, 8]


def test_eight_characters_are_counted_as_in_the_text(spark):
    edges = [s * (10**e + d) for s in (1, -1) for e in range(10) for d in (-1, 0, 1)]
    edges = [x for x in edges if -(2**31) <= x < 2**31] + [2**31 - 1, -(2**31), 20100101, None]
    df = column(spark, edges, "int")
    got = values(df.select(dates.eight_characters("x")))
    assert got == [None if x is None else len(str(x)) == 8 for x in edges]


def test_date_order_never_flags_null(spark):
    rows = [
        (1, 5, 4, 9),
        (2, 5, 9, 4),
        (3, 5, 5, 5),
        (4, None, 1, 1),
        (5, 5, None, 4),
        (6, 5, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, o int, s int, d int")
    found = checks.date_order_violations(df, "o", ["s", "d"])
    assert sorted(r.id for r in found.collect()) == [1, 2, 5]


def test_birth_dates_outside_the_range_are_shown_once(spark):
    days = ["1923-12-31", "1924-01-01", "2026-01-01", "2026-01-02", "1923-12-31", None]
    df = column(spark, [d and dt.date.fromisoformat(d) for d in days], "date")
    found = values(checks.date_out_of_range(df, "x", dt.date(2026, 1, 1)))
    assert sorted(found) == [dt.date(1923, 12, 31), dt.date(2026, 1, 2)]


# sales, quantity, price; every mix of NULL, negative, zero and positive.
MIXES = [
    (s, q, p)
    for s in (None, -7, 0, 6, 7)
    for q in (None, -2, 0, 2, 3)
    for p in (None, -3, 0, 3)
]


def product(q, p):
    return None if q is None or p is None else q * p


def quotient(a, b):
    if a is None or b is None or b == 0:
        return None
    return int(a / b)


def absolute(x):
    return None if x is None else abs(x)


def missing(x):
    return x is None or x <= 0


def spelled_out(policy, s, q, p):
    """The three policies row by row, as their rules are stated."""
    if policy == "recompute":
        expected = product(absolute(q), absolute(p))
        differs = s is not None and expected is not None and s != expected
        return (
            expected if missing(s) or differs else s,
            quotient(s, absolute(p)) if missing(q) else q,
            quotient(s, q) if missing(p) else p,
        )
    if policy == "trust_qty_price":
        usable = not missing(q) and not missing(p)
        return (q * p if usable else None, None if missing(q) else q, None if missing(p) else p)
    if missing(p):
        price = None if q in (None, 0) else quotient(absolute(s), absolute(q))
    else:
        price = p
    sales = None if missing(q) or missing(p) else abs(q) * abs(p)
    return (sales, absolute(q), price)


def shown(policy, s, q, p):
    some_missing = missing(s) or missing(q) or missing(p)
    if policy == "recompute":
        return some_missing or s != q * p
    return policy == "trust_qty_price" or some_missing


@pytest.mark.parametrize("policy", ["recompute", "trust_qty_price", "business"])
def test_repair_policies_row_by_row(spark, policy):
    rows = [(i, *mix) for i, mix in enumerate(MIXES)]
    df = spark.createDataFrame(rows, "id int, s int, q int, p int")
    got = repair_amounts(df, policy, "s", "q", "p", keep=["id"]).collect()
    assert {r.id: (r.s, r.q, r.p) for r in got} == {
        i: spelled_out(policy, *mix) for i, *mix in rows if shown(policy, *mix)
    }
    assert all((r.old_sales, r.old_qty, r.old_price) == MIXES[r.id] for r in got)
    if policy != "trust_qty_price":
        order = [tuple((v is not None, v or 0) for v in (r.s, r.q, r.p)) for r in got]
        assert order == sorted(order)


def test_repair_of_all_rows_leaves_right_ones_alone(spark):
    df = spark.createDataFrame([(6, 2, 3), (7, 2, 3)], "s int, q int, p int")
    fixed = repair_amounts(df, "recompute", "s", "q", "p", faulty_only=False)
    assert values(fixed.select("s", "q", "p")) == [(6, 2, 3), (6, 2, 3)]


def test_trusted_amounts_are_consistent_or_null(spark):
    df = spark.createDataFrame(MIXES, "s int, q int, p int")
    fixed = repair_amounts(df, "trust_qty_price", "s", "q", "p")
    assert fixed.where("s <> q * p or (s is null and q is not null and p is not null)").count() == 0


def test_amounts_that_overflow_int_do_not_stop_the_job(spark):
    big = 2_000_000_000
    df = spark.createDataFrame([(1, big, big), (-(2**31), 1, -(2**31))], "s int, q int, p int")
    assert checks.amount_violations(df, "s", "q", "p").count() == 2
    fixed = {r.old_sales: r.s for r in repair_amounts(df, "recompute", "s", "q", "p").collect()}
    assert fixed == {1: big * big, -(2**31): 2**31}


def test_decimal_amounts_keep_their_fraction(spark):
    df = spark.createDataFrame([("7.50", 2, None)], "s string, q int, p string").select(
        F.col("s").cast("decimal(18,2)"), "q", F.col("p").cast("decimal(18,2)").alias("p")
    )
    assert float(repair_amounts(df, "recompute", "s", "q", "p").first().p) == 3.75


def test_violation_counts_ignore_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    row = checks.count_violations(df, {"low": F.col("x") <= 0, "none": F.col("x").isNull()}).first()
    assert row.asDict() == {"rows": 3, "low": 1, "none": 1}
