"""Quality rules, mixing, licences and personal data."""

import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from siltwork.llm import licenses, mixing, personal_data, quality
from siltwork.llm.queries import RUN, SQL
from siltwork.llm.samples import some_rows
from tests.llm.rows import no_docs, no_turns, odd_docs, odd_turns, prose, same_as_sql, stored
from tests.oracle import connect, duck_rows, plan, spark_rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert name in contract.queries()
    result = RUN[name](spark, SMALL)
    assert spark_rows(result) == duck_rows(connect(SMALL), SQL[name])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql_on_odd_documents(spark, tmp_path, name):
    tables = {"documents": odd_docs(spark), "conversations": odd_turns(spark)}
    folder = stored(spark, tmp_path, **tables)
    result = RUN[name](spark, folder)
    assert same_as_sql(result, SQL[name], **{t: f"{folder}/{t}.parquet" for t in tables})


@pytest.mark.parametrize("name", sorted(RUN))
def test_query_on_empty_tables(spark, tmp_path, name):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    folder = stored(
        spark,
        tmp_path,
        documents=no_docs(spark),
        labels=labels,
        embeddings=vectors,
        conversations=no_turns(spark),
    )
    assert RUN[name](spark, folder).count() == 0


@pytest.mark.parametrize("name", ["op7_quality", "op9_personal_data", "op10_licenses"])
def test_native_queries_run_no_python(spark, name):
    text = plan(RUN[name](spark, SMALL))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_any_order_of_rules_keeps_the_same(spark):
    docs = odd_docs(spark).select("doc_id", "text")
    kept = set()
    for seed in range(3):
        rules = list(quality.RULES)
        random.Random(seed).shuffle(rules)
        rows = quality.cascade(docs, rules).where("rejected_by is null")
        kept.add(tuple(sorted(map(repr, rows.collect()))))
    assert len(kept) == 1


def test_rules_are_ordered_by_rejections_per_cost():
    a, b, c = (quality.Rule(n, (), "false") for n in "abc")
    estimates = [
        quality.Estimate(a, 1.0, 0.1), quality.Estimate(b, 0.1, 0.1), quality.Estimate(c, 1.0, 0.5)
    ]
    assert quality.in_order(estimates) == [b, c, a]


def test_passing_returns_whole_rows(spark):
    docs = odd_docs(spark)
    kept = quality.passing(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in quality.judged(docs).where("kept").collect()
    }


def filled(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = total - sum(fixed.values())
        given = {s: share * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if given[s] > 3 * sizes[s]]
        if not over:
            return fixed | given
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_share_the_excess(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 100000]) for i in range(9)} | {None: 50, "": 7}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    expected = filled(sizes)
    assert got.keys() == expected.keys()
    assert all(abs(got[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in got)


def test_mix_meets_targets_and_repeats_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixed(docs).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        taken = sum(r.size * r.copies for r in own)
        assert abs(taken - own[0].target) <= max(r.size for r in own) / 2 + 1
        assert max(r.copies for r in own) <= 3
        assert max(r.copies for r in own) - min(r.copies for r in own if r.size) <= 1
    repeated = mixing.repeated(docs)
    assert repeated.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in repeated.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in rows if r.copies}


def test_mix_keeps_columns_with_clashing_names(spark):
    docs = odd_docs(spark)
    repeated = mixing.repeated(docs)
    assert repeated.columns == docs.columns
    assert {r["size"] for r in repeated.collect()} <= {"x", None}
    assert spark_rows(repeated) == spark_rows(mixing.repeated(docs))


def test_license_is_found_in_any_usual_writing(spark):
    text = dict(licenses.LICENSES)["ISC"]
    written = (
        "Copyright (c) 2019 Some Body\n  (C) 2020 Another\nAll rights reserved.\n\n"
        + text.upper().replace(", ", " ,\n").replace('"', "'")
    )
    rows = [(1, written), (2, text + " And more."), (3, text), (4, "x\nReleased under the MIT Licence\ny")]
    got = {r.doc_id: r for r in licenses.scanned(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [got[i].license for i in (1, 2, 3, 4)] == ["ISC", None, "ISC", None]
    assert got[1].canonical_sha256 == got[3].canonical_sha256
    assert got[4].notices == "MIT"


def test_whole_texts_of_long_licenses_are_known(spark):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    rows = [(n, (folder / n).read_text("utf-8")) for n in names if (folder / n).exists()]
    rows = [(n, text.upper().replace("\n", "\r\n ")) for n, text in rows]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.license for r in licenses.scanned(docs).collect()}
    assert got == {n: names[n] for n, _ in rows}


def test_draws_of_low_quality_do_not_gather_in_a_range(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("12 34 56").alias("text"))
    ranges = mixing.drawn(rows).groupBy("__range").count()
    assert ranges.agg(F.max("count")).first()[0] <= 40


def test_forms_made_of_a_value_share_its_fold(spark):
    value = F.struct(
        F.lit(personal_data.KINDS.index("card")).alias("kind"),
        F.lit("4111 1111 1111 1111").alias("s"),
        F.lit("card ").alias("before"),
        F.lit("").alias("after"),
        F.lit(True).alias("sure"),
    )
    rows = personal_data._examples(spark.range(1).select(value.alias("x")).select("x.*"))
    assert rows.count() == 4 and rows.select("fold").distinct().count() == 1


FORMS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: max(int(p) for p in m.split(".")) <= 255,
    ),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = [
        (m.start(), kind, m.end())
        for kind, (form, holds) in enumerate(FORMS)
        for m in re.finditer(form, text or "")
        if holds(m[0])
    ]
    return [f"{personal_data.KINDS[k]}:{a}:{z}" for a, k, z in sorted(found)]


def personal_texts():
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@y", "4111 1111-1111 1111", "4111--1111", "+1 (555) 123-4567", "+49.30",
             "1.2.3.4", "300.1.2.3", ".5.6", "@", "-", " ", " ", "é", "😀", "\n", "12", "+", ")", "7"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(120)]
    return texts + [None, "", "9" * 50000, "1 " * 20000, "a@b.c " * 700, "no data here"]


def test_personal_data_base_spans_equal_plain_patterns(spark, tmp_path):
    rows = list(enumerate(personal_texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    folder = stored(spark, tmp_path, documents=docs)
    got = {r.doc_id: r for r in RUN["op9_personal_data"](spark, folder).collect()}
    for doc_id, text in rows:
        expected = base_spans(text)
        joined = ",".join(expected)
        assert got[doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        assert set(expected) <= set(got[doc_id].spans.split(",")) | {""}
        for kind in personal_data.KINDS:
            assert got[doc_id][f"n_{kind}"] == sum(s.startswith(kind) for s in expected)


def numbers_before_personal_data(spark, n=400):
    """Documents of plain numbers, then of each kind, the kinds one after the other."""
    rng = random.Random(11)

    def card():
        head = "".join(rng.choice("0123456789") for _ in range(15))
        return next(head + d for d in "0123456789" if luhn(head + d))

    def ip():
        return ".".join(str(rng.randrange(256)) for _ in range(4))

    texts = [" word ".join(str(rng.randrange(10, 10**6)) for _ in range(40)) for _ in range(100)]
    texts += [f"mail me at {prose(i, 1)}{i}@example.org please" for i in range(n)]
    texts += [f"the host {ip()} is down" for _ in range(n)]
    texts += [f"my card {card()} was charged" for _ in range(n)]
    texts += [f"call +49 {rng.randrange(200, 999)} {rng.randrange(10**6, 10**7)} today" for _ in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(2)


def test_trees_and_thresholds_come_from_the_whole_table(spark):
    docs = numbers_before_personal_data(spark)
    model = personal_data.fitted(docs)
    assert model is not None
    assert max(model.thresholds) <= 1
    again = personal_data.fitted(docs.orderBy(F.desc("doc_id")))
    assert personal_data._parsed(again.trees) == personal_data._parsed(model.trees)
    assert again.thresholds == model.thresholds


def test_sample_is_bounded_for_each_kind_and_label(spark):
    spans = spark.range(4000).selectExpr(
        "int(id % 2) as kind", "id % 500 > 0 as sure", "string(id) as s", "'' as before", "'' as after"
    )
    got = personal_data.sampled(spans.unionAll(spans), 50)
    counts = {(r.kind, r.sure): r["count"] for r in got.groupBy("kind", "sure").count().collect()}
    assert counts[0, True] == counts[1, True] == 50
    assert 0 < counts[0, False] <= 8 and (1, False) not in counts
    assert got.distinct().count() == got.count()


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    docs = spark.createDataFrame(
        [(1, "é mail a@b.de or +1 (555) 123-4567!", "k"), (2, None, "k"), (3, "", None), (4, "x", "k")],
        "doc_id int, text string, kind string",
    )
    got = {r.doc_id: r for r in personal_data.redacted(docs).collect()}
    assert got[1].text == "é mail [email] or [phone]!"
    assert [got[i].text for i in (2, 3, 4)] == [None, "", "x"]
    assert got[1].kind == "k"


def test_description_of_trees_becomes_an_expression(spark):
    text = """GBT: 2 trees
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     Predict: -1.0
    Else (feature 0 > 1.5)
     If (feature 1 <= 2.0)
      Predict: 0.5
     Else (feature 1 > 2.0)
      Predict: 1.0
  Tree 1 (weight 0.5):
    Predict: 0.2
"""
    model = personal_data.Model(text, ())
    rows = spark.createDataFrame([([1.0, 0.0],), ([2.0, 1.0],), ([2.0, 3.0],)], "f array<double>")
    got = [r[0] for r in rows.select(model.probability(F.col("f"))).collect()]
    margins = [-1.0 + 0.1, 0.5 + 0.1, 1.0 + 0.1]
    assert got == pytest.approx([1 / (1 + 2.718281828459045 ** (-2 * m)) for m in margins])


def test_sampled_texts_stay_out_of_plans(spark):
    """Texts held by the driver stay in the plans of its queries."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('secretword ', id) AS text")
    some = some_rows(docs.select("text"), 500)
    assert "secretword 1" not in some._jdf.queryExecution().toString()
    texts = [int(row.text.split()[1]) for row in some.collect()]
    assert 350 < len(texts) < 650 and max(texts) > 1500
    assert some_rows(docs, 5000).count() == 2000
