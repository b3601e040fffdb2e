"""Key operators against brute force, under the plain and the spreading plans."""

import random
from collections import Counter, defaultdict

import pytest

from siltwork.operators import keys
from siltwork.operators.lookups import lookup, orphans
from siltwork.operators.skew import SkewPolicy, find_hot, spread_join
from siltwork.session import write_out

PLAIN = SkewPolicy()
SPREAD = SkewPolicy(hot_rows=25)
MANY_HOT = SkewPolicy(hot_rows=3)
POLICIES = pytest.mark.parametrize("skew", [PLAIN, SPREAD, MANY_HOT], ids=["plain", "spread", "many"])

# key, order, payload: NULL holds a third of the rows, one key is mostly copies.
RANDOM = random.Random(7)
ROWS = (
    [(None, RANDOM.choice([None, 1, 2, 3]), RANDOM.randrange(50)) for _ in range(200)]
    + [(1, 5, 9)] * 150
    + [(1, RANDOM.randrange(9), RANDOM.randrange(50)) for _ in range(50)]
    + [(RANDOM.randrange(2, 60), RANDOM.choice([None, 1, 2]), i) for i in range(200)]
)


@pytest.fixture(scope="module")
def df(spark):
    rows = list(ROWS)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k int, o int, v int").repartition(5)


def low_none(x):
    return (x is not None, x if x is not None else 0)


def numbered(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    for group in groups.values():
        group.sort(key=lambda r: (low_none(r[1]), low_none(r[2])), reverse=True)
        yield from ((*row, i) for i, row in enumerate(group, 1))


def bag(frame):
    return Counter(tuple(r) for r in frame.collect())


@POLICIES
def test_number_rows(df, skew):
    assert bag(keys.number_rows(df, "k", "o", skew=skew)) == Counter(numbered(ROWS))


@POLICIES
def test_superseded(df, skew):
    expected = Counter(r for r in numbered(ROWS) if r[3] != 1)
    assert bag(keys.superseded_rows(df, "k", "o", skew=skew)) == expected


def test_latest(df):
    expected = Counter(r[:3] for r in numbered(ROWS) if r[3] == 1 and r[0] is not None)
    assert bag(keys.latest_per_key(df, "k", "o")) == expected


def test_latest_and_superseded_are_the_input_but_for_one_null_row(df):
    both = bag(keys.latest_per_key(df, "k", "o")) + bag(
        keys.superseded_rows(df, "k", "o", skew=SPREAD).drop(keys.ROW_NUMBER)
    )
    left_over = Counter(ROWS) - both
    assert sum(left_over.values()) == 1 and next(iter(left_over))[0] is None
    assert not both - Counter(ROWS)


COUNTS = Counter(r[0] for r in ROWS)


@POLICIES
@pytest.mark.parametrize("include_null", [False, True])
def test_duplicate_rows(df, skew, include_null):
    expected = Counter(
        r for r in ROWS if (include_null if r[0] is None else COUNTS[r[0]] > 1)
    )
    assert bag(keys.duplicate_rows(df, "k", include_null, skew)) == expected


@POLICIES
def test_ranked_duplicates(df, skew):
    expected = Counter(r for r in numbered(ROWS) if r[0] is None or COUNTS[r[0]] > 1)
    assert bag(keys.ranked_duplicates(df, "k", "o", skew=skew)) == expected


def test_single_null_key_is_a_violation(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (2,)], "k int")
    assert bag(keys.pk_violations(df, "k")) == Counter({(None, 1): 1, (2, 2): 1})
    assert keys.duplicate_rows(df, "k").count() == 2
    assert keys.duplicate_rows(df, "k", include_null=True).count() == 3


@POLICIES
def test_composite_keys(spark, skew):
    rows = [(i % 3 or None, i % 2, i) for i in range(120)]
    df = spark.createDataFrame(rows, "a int, b int, o int")
    got = keys.number_rows(df, ["a", "b"], "o", skew=skew)
    groups = defaultdict(list)
    for a, b, o in rows:
        groups[a, b].append(o)
    expected = Counter(
        (a, b, o, i)
        for (a, b), items in groups.items()
        for i, o in enumerate(sorted(items, reverse=True), 1)
    )
    assert bag(got) == expected
    assert keys.latest_per_key(df, ["a", "b"], "o").count() == 4


@POLICIES
def test_following_value(df, skew):
    got = keys.following_value(df, "k", "o", "v", "later", skew=skew)
    expected, previous = Counter(), {}
    for k, o, v, _ in numbered(ROWS):
        expected[k, o, v, previous.get(k)] += 1
        previous[k] = v
    assert bag(got) == expected


@POLICIES
def test_lookup_and_orphans(spark, df, skew):
    table = {k: f"name {k}" for k in range(0, 60, 2)} | {1: "one"}
    names = spark.createDataFrame(list(table.items()), "k int, name string")
    got = lookup(df, names, "k", skew)
    assert bag(got) == Counter((*r, table.get(r[0])) for r in ROWS)
    assert bag(orphans(df, names, "k", skew)) == Counter(r for r in ROWS if r[0] not in table)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_the_plain_join(spark, df, how, null_safe):
    right = spark.createDataFrame([(None, 0), (1, 1), (1, 2), (3, 3)], "k int, w int")
    hot = find_hot(df, "k", SPREAD)
    assert hot is not None
    plain = spread_join(df, right, "k", how, None, null_safe)
    spread = spread_join(df, right, "k", how, hot, null_safe)
    assert plain.columns == spread.columns
    assert bag(plain) == bag(spread)


def test_join_refuses_columns_on_both_sides(df):
    with pytest.raises(ValueError, match="both sides"):
        spread_join(df, df, "k", "left", None)


@pytest.mark.parametrize("skew", [SPREAD, MANY_HOT])
def test_all_hot_keys_are_listed(df, skew):
    hot = find_hot(df, "k", skew)
    expected = {k: n for k, n in COUNTS.items() if n >= skew.hot_rows}
    assert {r.k for r in hot.frame.collect()} == set(expected)
    assert hot.rows == sum(expected.values())


def test_a_table_of_one_key_is_spread_however_well_it_compresses(spark):
    stored = write_out(spark.range(200_000).selectExpr("cast(null as int) k", "1 o"), "one-key")
    assert find_hot(stored, "k") is None  # less than the default for a task
    hot = find_hot(stored, "k", SkewPolicy(hot_rows=50_000))
    assert (hot.rows, hot.slices) == (200_000, 4)
    numbers = keys.number_rows(stored, "k", "o", skew=SkewPolicy(hot_rows=50_000))
    assert len(numbers.inputFiles()) > 1
    assert numbers.agg({"flag_latest_date": "max"}).first()[0] == 200_000


def test_numbering_cuts_copies_of_one_row_into_many_ranges(spark):
    copies = spark.range(0, 4000, 1, 8).selectExpr("cast(null as int) k", "1 o", "2 v")
    skew = SkewPolicy(hot_rows=500)
    got = keys.number_rows(copies, "k", "o", skew=skew)
    assert sorted(r.flag_latest_date for r in got.collect()) == list(range(1, 4001))
    scan = got.inputFiles()
    assert len(scan) >= 4  # one written file per range that received rows


def test_keys_of_a_few_rows_share_ranges(spark):
    rows = spark.range(0, 3000, 1, 4).selectExpr("id div 3 as k", "id as o", "-id as v")
    followed = keys.following_value(rows, "k", "o", "v", "later", skew=MANY_HOT)
    numbers = keys.number_rows(rows, "k", "o", skew=MANY_HOT)
    for found in (followed, numbers):
        written = [f for f in found.inputFiles() if "/numbered-" in f]
        assert 1 < len(written) <= 8  # as many as shuffles have partitions, not one per key
    assert bag(followed) == Counter(
        (i // 3, i, -i, None if i % 3 == 2 else -i - 1) for i in range(3000)
    )
    assert bag(numbers) == Counter((i // 3, i, -i, 3 - i % 3) for i in range(3000))


def test_keys_cut_by_ranges_of_a_few_rows(df):
    """Ranges of about six rows, so that the larger keys lie in many."""
    skew = SkewPolicy(hot_rows=3, least_rows=6)
    assert find_hot(df, "k", skew).slices > 80
    assert bag(keys.number_rows(df, "k", "o", skew=skew)) == Counter(numbered(ROWS))
    plain = keys.following_value(df, "k", "o", "v", "later", skew=PLAIN)
    assert bag(keys.following_value(df, "k", "o", "v", "later", skew=skew)) == bag(plain)
