"""Packing, near duplicates and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from siltwork.llm import near_duplicates, packing
from siltwork.llm.components import components
from siltwork.llm.queries import RUN
from siltwork.llm.subwords import subwords
from siltwork.session import write_out
from tests.llm.rows import no_docs, odd_docs, prose, stored


def check_packing(rows, docs):
    encoder = subwords()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        ids = np.array(ids, dtype="<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = tokens = 0
    for group in sequences.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 4096
        tokens += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding / tokens


def test_packing_round_trip(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert check_packing(RUN["op3_packing"](spark, folder).collect(), docs) < 0.01


def test_packing_of_odd_documents(spark, tmp_path):
    docs = odd_docs(spark)
    folder = stored(spark, tmp_path, documents=docs.dropDuplicates(["doc_id"]))
    kept = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_packing(RUN["op3_packing"](spark, folder).collect(), kept)
    # With repeated rows each gets pieces of its own.
    both = packing.packed(docs).groupBy("doc_id").sum("length").collect()
    once = packing.packed(docs.where("doc_id = 5").limit(1)).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in both}[5] == 2 * once[0][1]


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_up_the_histogram(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 4096): rng.choice([1, 2, 30, 5000]) for _ in range(rng.choice([1, 40, 900]))}
    used = Counter()
    for combo in packing.plan(histogram):
        assert sum(combo.lengths) <= 4096
        for length in combo.lengths:
            used[length] += combo.repeats
    assert used == histogram


def test_places_are_gapless_and_sequences_powers_of_two_or_nearly_full():
    histogram = {700: 3, 1500: 5, 4000: 2, 96: 2, 33: 1}
    rows = packing.places(packing.plan(histogram), 4096, 64)
    sequences, used = defaultdict(list), Counter()
    for left, first, last, start, length, sequence, step, offset in rows:
        for n in range(first, last + 1):
            sequences[sequence + (n - first) * step].append((offset, length))
            used[left, n, start] += length
    for group in sequences.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 or 4096 - at <= 64
    total = Counter()
    for (left, n, _), length in used.items():
        total[left, n] += length
    assert total == {(left, n): left for left, count in histogram.items() for n in range(count)}


def brute_groups(rows, size):
    """Smallest id reachable over links of 80 in a hundred, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    smallest = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        smallest[root(i)].append(doc_id)
    named = {r: min((d for d in ids if d is not None), default=None) for r, ids in smallest.items()}
    return Counter((rows[i][0], len(sets[i]), named[root(i)]) for i in range(len(rows)))


def edited(text, n, rng):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def planted(seed):
    """Groups of copies with few and many edits, a shared passage, chains, short texts."""
    rng = random.Random(seed)
    texts = [prose(1000 + i, rng.randrange(3, 120)) for i in range(60)]
    passage = prose(9, 55)
    texts += [prose(2000 + i, 60) + " " + passage for i in range(25)]
    base = prose(77, 150)
    texts += [edited(base, rng.randrange(0, 22), rng) for _ in range(70)]
    chain = prose(78, 90)
    for _ in range(25):
        chain = edited(chain, 3, rng)
        texts.append(chain)
    texts += [base] * 5 + [base.upper()] + ["a b", "a b c", "a", "a", "", None, "b a b a b a"]
    rng.shuffle(texts)
    ids = rng.sample(range(10**6), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(spark, size):
    rows = planted(size)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = near_duplicates.grouped(docs, size=size)
    found = Counter((r.doc_id, r["__n"], r["__component"]) for r in got.collect())
    assert found == brute_groups(rows, size)


def test_groups_of_odd_documents(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates.grouped(docs, size=2)
    found = Counter((r.doc_id, r["__n"], r["__component"]) for r in got.collect())
    assert found == brute_groups(rows, 2)
    kept = near_duplicates.deduplicated(docs, size=2)
    assert kept.columns == docs.columns
    # One row of each group; rows without words are groups of their own.
    assert kept.where("doc_id = 5").count() == 1
    assert kept.where("text is null").count() == 2


def test_blocks_of_any_size_find_the_same(spark, monkeypatch):
    rows = planted(3)
    whole = near_duplicates._blocks
    monkeypatch.setattr(near_duplicates, "_blocks", lambda m, main, _: whole(m, main, 4))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_duplicates.grouped(docs, size=2)
    found = Counter((r.doc_id, r["__n"], r["__component"]) for r in got.collect())
    assert found == brute_groups(rows, 2)


def test_least_shared_has_the_stated_chance():
    s = near_duplicates.least_shared(64, 0.8)
    below = sum(math.comb(64, i) * 0.8**i * 0.2 ** (64 - i) for i in range(s))
    assert below <= near_duplicates.MISS < below + math.comb(64, s) * 0.8**s * 0.2 ** (64 - s)


def test_listed_values_meet_for_sets_on_both_sides_of_a_sketch():
    k = near_duplicates.K
    for n in range(1, k + 1):
        listed = near_duplicates.listed_of_whole(n, k, 0.8)
        for m in range(n, 100 * n // 80 + 1):
            shared = -(-80 * (n + m) // 180)
            assert listed > n - (shared - max(m - k, 0))


def test_whole_sets_are_linked_with_cut_ones(spark):
    """Sets of 60 to 64 shingles in sets of 65 to 80, at 80 in a hundred or above."""
    texts = []
    for i in range(40):
        for n in range(60, 65):
            m = 100 * n // 80 - i % 2
            words = [f"p{i}x{n}x{j}" for j in range(m)]
            texts += [" ".join(words[:n]), " ".join(words)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_duplicates.grouped(docs, size=1)
    found = {(r.doc_id, r["__component"]) for r in got.collect()}
    assert found == {(i, i - i % 2) for i in range(len(texts))}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == expected
    assert components(df.where("false")).count() == 0


def test_pipeline_stages_one_by_one(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns, before = docs.columns, docs
        docs = write_out(stage(spark, before, folder), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, kept = seen["quality_rules"]
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1")
    long = before.join(labels, "doc_id", "left_semi").where("size(split(text, ' ')) > 60")
    assert long.join(kept, "doc_id", "left_anti").count() == 0
    before, kept = seen["near_duplicates"]
    groups = brute_groups([(r.doc_id, r.text) for r in before.collect()], 5)
    assert {r.doc_id for r in kept.collect()} == {named for _, _, named in groups}
    before, clean = seen["personal_data"]
    assert clean.count() == before.count()
    assert clean.where(r"text rlike '[a-z]+@[a-z0-9]+[.]example'").count() == 0
    before, mix = seen["source_mix"]
    assert mix.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    mixed = Counter((r.doc_id, r.text) for r in mix.collect())
    total = {r[0]: r[1] for r in seen["packing"][1].groupBy("doc_id").sum("length").collect()}
    encoder = subwords()
    assert total == {
        d: n * (len(encoder.ids([text])[0]) + 1) for (d, text), n in mixed.items()
    }


@pytest.mark.parametrize("rows", [odd_docs, no_docs])
def test_pipeline_of_odd_and_no_documents(spark, rows):
    docs = rows(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = write_out(stage(spark, docs, ""), f"test-{name}")
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)
