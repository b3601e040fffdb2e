"""Neighbours, toxicity, language and the language model."""

import math
import os
import tracemalloc
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from siltwork.llm import attention, language, language_model, neighbours, toxicity
from siltwork.llm.queries import RUN
from siltwork.llm.subwords import Subwords, subwords
from tests.llm.rows import odd_docs, stored

SF = "/root/testdata/sf0.01"


def held(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 2


def brute_neighbours(rows, query_id, k):
    own = next(v for i, v in rows if i == query_id)
    scores = sorted((-float(np.dot(own, v)), i) for i, v in rows if i != query_id)
    return scores[:k]


def test_neighbours_have_recall_and_exact_scores(spark):
    rows = [
        (r.vec_id, np.array(r.embedding, dtype=np.float64))
        for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ]
    got = {}
    for r in RUN["op1_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    vectors = dict(rows)
    hits = total = 0
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    for query_id, found in got.items():
        expected = {i for _, i in brute_neighbours(rows, query_id, 20)}
        assert sorted(found) == list(range(1, 21))
        hits += len(expected & {i for i, _ in found.values()})
        total += 20
        order = [(-s, i) for _, (i, s) in sorted(found.items())]
        assert order == sorted(order)
        for i, score in found.values():
            assert score == pytest.approx(float(vectors[query_id] @ vectors[i]), abs=1e-12)
    assert hits / total >= 0.9


def test_neighbours_where_density_differs(spark):
    """Tight groups beside scattered vectors, as doubles: full results, exact scores, recall."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(60, 64))
    grouped = (middles[:, None, :] + 0.05 * rng.normal(size=(60, 40, 64))).reshape(-1, 64)
    x = np.vstack([grouped, rng.normal(size=(1600, 64))])
    rows = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>"
    )
    found = {}
    for r in neighbours.nearest(rows, rows.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    recall = {True: [], False: []}
    for q in range(0, len(x), 20):
        scores = x @ x[q]
        assert len(found[q]) == 20
        assert all(abs(score - scores[i]) < 1e-9 for i, score in found[q].items())
        scores[q] = -np.inf
        best = set(np.argsort(-scores)[:20].tolist())
        recall[q < len(grouped)].append(len(best & set(found[q])) / 20)
    assert min(np.mean(r) for r in recall.values()) >= 0.95


def test_neighbours_of_odd_vectors(spark):
    good = [(i, [float(i % 3), 1.0]) for i in range(30)]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [math.nan, 1.0]), (100, [math.inf, 1.0]),
           (120, [None, 1.0]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows = spark.createDataFrame(good + bad + good[:5], "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), k=20).collect()
    assert {r.query_id for r in got} == {0, 20}
    exact = [(i, np.array(v)) for i, v in good]
    for query_id in (0, 20):
        found = sorted((r["rank"], r.vec_id) for r in got if r.query_id == query_id)
        assert [i for _, i in found] == [i for _, i in brute_neighbours(exact, query_id, 20)]


def test_fewer_vectors_than_asked_for(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(rows, rows.where("vec_id = 0"), k=20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5)]


def outputs(text):
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": 2.0, "moro": 1.0}))
    counts = np.expm1(scorer.counts(text))
    return {o: round(c) for o, c in zip(toxicity.OUTPUTS, counts) if round(c)}


def test_grammar_tells_clauses_apart():
    assert outputs("what an idiot") == {"I": 1}
    assert outputs("you are an IDIOT. really, morons") == {"i": 1, "I": 1}
    assert outputs("you are not an idiot") == {"n": 1}
    assert outputs("she said he is an idiot") == {"q": 1}
    assert outputs("i will kill you") == {"T": 1}
    assert outputs("they will kill") == {"t": 1}
    assert outputs(None) == outputs("") == outputs("a calm day; nothing else") == {}


def test_composed_machine_equals_its_parts_in_turn():
    parts = [
        toxicity.window_machine("N", 3, {"I": "n", "T": "n"}),
        toxicity.window_machine("R", 12, {"I": "q", "T": "q"}),
        toxicity.window_machine("P", 4, {"I": "i", "T": "t"}),
    ]
    whole = toxicity.grammar()
    rng = np.random.default_rng(1)
    for _ in range(200):
        symbols = rng.choice(list("ITPNRO"), 15)
        states, state, single, composed = ["0"] * 3, "0|0|0", [], []
        for symbol in symbols:
            out = symbol
            for k, part in enumerate(parts):
                states[k], out = part[states[k], out]
            single.append(out)
            state, out = whole[state, symbol]
            composed.append(out)
        assert single == composed


def test_toxicity_of_documents_not_learned_from(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = RUN["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10000
    kept = [r for r in rows if r.doc_id in labels and held(r.doc_id, 4)]
    assert all(r.held_out == held(r.doc_id, 4) for r in rows)
    toxic = [r for r in kept if labels[r.doc_id]]
    clean = [r for r in kept if not labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_a_target_directs_what_stands_on_either_side_of_it():
    scorer = toxicity.Scorer(toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 1.0)))
    directed = toxicity.OUTPUTS.index("I"), toxicity.OUTPUTS.index("i")
    for text in ("you stupid", "stupid you", "an idiot, you idiot"):
        assert scorer.counts(text)[directed[1]] > 0
    assert scorer.counts("a stupid stone")[directed[1]] == 0
    assert scorer.counts("he said you are stupid")[directed[1]] == 0


def test_labels_are_sampled_apart():
    assert toxicity.shares({0: 900, 1: 50}, 1000) == {0: 1.0, 1: 1.0}
    few = toxicity.shares({0: 10**9, 1: 500}, 1000)
    assert few[1] == 1.0 and few[0] == 500 / 10**9
    assert toxicity.shares({0: 100}, 1000) == {0: 1.0, 1: 1.0}


def test_toxicity_of_odd_documents_without_labels(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    folder = stored(spark, tmp_path, documents=odd_docs(spark), labels=labels)
    rows = RUN["op2_toxicity"](spark, folder).collect()
    assert len(rows) == odd_docs(spark).count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_language_of_documents_not_learned_from(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = RUN["op8_language"](spark, SF).collect()
    kept = [r for r in rows if held(r.doc_id, 4)]
    assert sum(r.lang_pred == langs[r.doc_id] for r in kept) >= 0.97 * len(kept)
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4) for r in rows)


def test_language_of_odd_documents(spark, tmp_path):
    folder = stored(spark, tmp_path, documents=odd_docs(spark))
    rows = RUN["op8_language"](spark, folder).collect()
    assert len(rows) == odd_docs(spark).count()
    texts = {r.doc_id: r.text for r in odd_docs(spark).collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            text = texts[r.doc_id]
            assert (r.lang_pred == "und") == (not text or not any(map(str.isalpha, text)))


def test_softmax_scores_equal_averaged_embeddings():
    rng = np.random.default_rng(0)
    counts = np.stack([language.buckets(t) for t in ["ab cd ef", "xy zz", "ab ab", "xy xy zz zz"] * 5])
    model = language.fit(counts, np.array([0, 1] * 2 * 5), ("a", "b"))
    assert [model.predict(t)[0] for t in ("ab cd", "zz xy")] == ["a", "b"]
    assert model.predict("12 34") == ("und", 0.0, True)
    assert rng is not None


def naive(model, classes):
    """Each position by itself, with the context its window gives it."""
    p, out = model.p, []
    inputs = [model.classes, *classes[:-1]]
    for t, target in enumerate(classes):
        first = (t // attention.SCORED) * attention.SCORED - attention.BEFORE
        places = [j for j in range(max(first, 0), t + 1)]
        q = (p["embed"][inputs[t]] + p["place_q"][t % attention.SCORED]) @ p["q"]
        keys = np.array([(p["embed"][inputs[j]] + p["place_k"][j - first]) @ p["k"] for j in places])
        values = np.array([p["embed"][inputs[j]] @ p["v"] for j in places])
        weights = np.exp(keys @ q / math.sqrt(attention.WIDTH))
        mixed = weights @ values / weights.sum()
        own = (p["embed"][inputs[t]] + p["place_q"][t % attention.SCORED]) @ p["own"]
        logits = np.tanh(mixed + own) @ p["out"] + p["bias"]
        out.append(logits[target] - math.log(np.exp(logits).sum()))
    return np.array(out)


@pytest.mark.parametrize("length", [1, 15, 16, 17, 70])
def test_windows_score_each_token_once_as_one_by_one(length):
    model = attention.Attention.new(7)
    classes = np.random.default_rng(length).integers(0, 7, length)
    x, y = attention.windows(classes, 7, 8)
    got = model.tables().log_chances(x, y)
    assert (y >= 0).sum() == length
    assert got[y >= 0] == pytest.approx(naive(model, classes), abs=1e-4)


def test_each_id_is_scored_with_sixteen_before_it():
    n = 70
    inputs, targets = attention.windows(np.arange(n), n, n + 1)
    for row, scored in zip(inputs, targets):
        for i, target in enumerate(scored):
            seen = row[attention.MASK[i] == 0]
            before = seen[seen < n]
            if target >= 0:
                assert len(before) >= min(16, target)


def test_gradients_are_slopes():
    model = attention.Attention.new(5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(2)
    x, y = attention.windows(rng.integers(0, 5, 40), 5, 6)
    _, slopes = model.gradients(x, y)
    for name, slope in slopes.items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept, step = model.p[name][at], 1e-5
        model.p[name][at] = kept + step
        above = model.gradients(x, y)[0]
        model.p[name][at] = kept - step
        below = model.gradients(x, y)[0]
        model.p[name][at] = kept
        assert slope[at] == pytest.approx((above - below) / (2 * step), rel=1e-3, abs=1e-6)


def base_scores(docs):
    counts = Counter()
    words = {}
    for doc_id, text in docs:
        words[doc_id] = [*(text or "").encode().lower().split(), "end"]
        if not held(doc_id, 7):
            counts.update(words[doc_id])
    n, v = sum(counts.values()), len(counts)
    return n, {
        d: (len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for d, ws in words.items()
    }


def check_scores(rows, docs):
    n, expected = base_scores(docs)
    for r in rows:
        tokens, known, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == held(r.doc_id, 7)
        assert r.score < 0 and math.isfinite(r.score)


def test_language_model_base_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = RUN["op6_language_model"](spark, folder).collect()
    assert len(rows) == len(docs)
    check_scores(rows, docs)


def test_language_model_of_odd_documents(spark, tmp_path):
    docs = odd_docs(spark).dropDuplicates(["doc_id"]).where("doc_id is not null")
    folder = stored(spark, tmp_path, documents=docs)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_scores(RUN["op6_language_model"](spark, folder).collect(), docs)


def test_classes_hold_every_id_and_sum_to_one():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, 500).astype(float)
    class_of, within = language_model.classes_of(
        counts, rng.integers(0, language_model.TOPICS + 1, 500), rng.integers(0, 2, 500)
    )
    assert class_of.max() < language_model.CLASSES
    for c in np.unique(class_of):
        assert np.exp(within[class_of == c]).sum() == pytest.approx(1.0)


def one_by_one(model, words, begun, spelled_share, discount):
    """Log chance of each word of a text, from the naive model, one after the other."""
    classes = [int(model.class_of[i]) for ids, _ in words for i in ids]
    chances = iter(naive(model.attention, classes))
    out = []
    for ids, count in words:
        each = [next(chances) for _ in ids]
        first = int(model.class_of[ids[0]])
        share = (1 - spelled_share) * max(count - discount, 0) / max(begun[first], 1)
        rest = sum(each[1:]) + sum(float(model.within[i]) for i in ids)
        out.append(each[0] + math.log(share + math.exp(model.left[first] + rest)))
    return out


def test_words_scored_as_one_by_one():
    rng = np.random.default_rng(8)
    size, classes = 90, language_model.CLASSES
    class_of = rng.integers(0, classes, size).astype(np.uint8)
    within = np.log(rng.random(size)).astype(np.float32)
    begun = rng.integers(0, 40, classes)
    left = np.log(rng.uniform(0.02, 0.9, classes))
    model = attention.Attention.new(classes)
    found = language_model.Model(class_of, within, begun, left, model.tables())
    texts = [
        [(rng.integers(0, size, rng.integers(1, 5)), int(rng.integers(0, 30))) for _ in range(n)]
        for n in (1, 9, 40)
    ]
    given = [
        (
            np.concatenate([ids for ids, _ in words]),
            np.array([len(ids) for ids, _ in words]),
            np.array([count for _, count in words]),
        )
        for words in texts
    ]
    object.__setattr__(found, "attention", model)
    share, less = language_model.SPELLED, language_model.DISCOUNT
    expected = [x for words in texts for x in one_by_one(found, words, begun, share, less)]
    assert found.words(given) == pytest.approx(expected, abs=1e-3)


def test_chances_of_all_words_sum_to_one_at_most():
    """All words of one id, known or not, after the same context."""
    rng = np.random.default_rng(9)
    size, classes = 300, language_model.CLASSES
    counts = rng.integers(0, 6, size).astype(float)
    class_of, within = language_model.classes_of(
        counts, rng.integers(0, language_model.TOPICS + 1, size), rng.integers(0, 2, size)
    )
    begun = np.bincount(class_of, counts, classes)
    words = np.bincount(class_of, counts > 0, classes)
    free = np.where(begun > 0, language_model.DISCOUNT * words / np.maximum(begun, 1), 1.0)
    left = np.log(language_model.SPELLED + (1 - language_model.SPELLED) * free)
    model = language_model.Model(
        class_of, within, begun, left, attention.Attention.new(classes).tables()
    )
    before = rng.integers(0, size, 20)
    ones = np.ones(21, dtype=np.int64)
    chances = [
        math.exp(model.words([(np.append(before, i), ones, np.append(counts[before], counts[i]))])[-1])
        for i in range(size)
    ]
    used = np.unique(class_of)
    x, _ = attention.windows(class_of[np.append(before, 0)].astype(np.int64), classes, classes + 1)
    possible = 0.0
    for c in used:
        y = np.full((len(x), attention.SCORED), -1)
        y[-1, 20 % attention.SCORED] = c
        possible += math.exp(model.scorer.log_chances(x, y).sum())
    assert sum(chances) == pytest.approx(possible, rel=1e-3)


def test_parameters_in_one_row_and_back():
    model = attention.Attention.new(6)
    again = attention.Attention.new(6, seed=1).with_flat(model.flat())
    for name, values in model.p.items():
        assert np.array_equal(values, again.p[name])


def test_attention_makes_held_out_words_likelier(spark):
    """Against the same words with classes by their share alone."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000").collect()
    encoder = subwords()
    end = np.array([encoder.size - 1])
    split = {False: [], True: []}
    for row in docs:
        split[held(row.doc_id, 7)].append([*(row.text or "").lower().split(), None])
    counted = Counter(w for words in split[False] for w in words)
    ids = {w: end if w is None else encoder.ids([w])[0] for words in sum(split.values(), []) for w in words}
    sums = np.zeros((3, encoder.size + 1))
    for word, n in counted.items():
        np.add.at(sums[0], ids[word], n)
        sums[1:, ids[word][0]] += n, 1
    rows = [(0, bytearray(np.concatenate([ids[w] for w in t]).astype("<u2").tobytes())) for t in split[False]]
    sample = spark.createDataFrame(rows, "part long, ids binary")
    model = language_model.trained(sample, language_model.Counted(*sums), language_model.TOKENIZER)
    share = np.bincount(model.class_of, sums[0, :-1] + 1.0, language_model.CLASSES)
    alone = replace(
        model.scorer, out=np.zeros_like(model.scorer.out),
        bias=np.log(np.maximum(share, 1e-9) / share.sum()).astype(np.float32),
    )
    texts = [
        (
            np.concatenate([ids[w] for w in t]).astype(np.int64),
            np.array([len(ids[w]) for w in t]),
            np.array([counted[w] for w in t]),
        )
        for t in split[True][:150]
    ]
    by_attention = model.words(texts).mean() / math.log(10)
    by_counts = replace(model, scorer=alone).words(texts).mean() / math.log(10)
    assert by_attention > by_counts + 0.1, (by_attention, by_counts)


def test_what_is_learned_grows_with_the_corpus(spark):
    texts = spark.range(30_000).selectExpr(
        "id AS chunk", "0 AS row", "id AS doc_id", "id % 7 = 0 AS held_out",
        "concat('some words of text ', id) AS text",
    )
    few = language_model.sampled(texts.where("doc_id < 300"), language_model.TOKENIZER).count()
    many = language_model.sampled(texts, language_model.TOKENIZER).count()
    assert few == 257
    assert many == pytest.approx(30_000 * 6 / 7 / language_model.ONE_IN, rel=0.1)


def test_all_training_texts_are_learned_from_once(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text")
    seen = []

    def learned(sample, sums, path):
        for turn in range(language_model.ROUNDS):
            def run(batches, turn=turn):
                ids = [ids.tobytes() for _, ids in language_model._learned(batches, turn)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

            seen.extend(bytes(row.ids) for row in sample.mapInArrow(run, "ids binary").collect())
        raise StopIteration

    monkeypatch.setattr(language_model, "trained", learned)
    with pytest.raises(StopIteration):
        language_model.scored(docs)
    encoder = subwords()
    texts = [f"some words of text {i}" for i in range(3000) if not held(i, 7)]
    ends = np.array([encoder.size - 1], dtype="<u2").tobytes()
    assert sorted(seen) == sorted(ids.astype("<u2").tobytes() + ends for ids in encoder.ids(texts))


def test_training_takes_all_windows_before_any_comes_again(monkeypatch):
    model = attention.Attention.new(5)
    inputs = np.repeat(np.arange(50)[:, None] % 5, attention.WINDOW, axis=1)
    targets = np.arange(50)[:, None].repeat(attention.SCORED, axis=1)
    rows = []
    monkeypatch.setattr(
        model, "gradients", lambda x, y: rows.extend(y[:, 0]) or (0.0, {k: 0 * v for k, v in model.p.items()})
    )
    model.train(inputs, targets, 5, batch=10)
    assert sorted(rows) == list(range(50))


def test_scores_too_large_for_a_power_of_e():
    model = attention.Attention.new(7)
    model.p["k"] *= 2000
    model.p["out"] *= 300
    classes = np.random.default_rng(4).integers(0, 7, 40)
    x, y = attention.windows(classes, 7, 8)
    assert np.isfinite(model.tables().log_chances(x, y)).all()
    assert all(np.isfinite(g).all() for g in model.gradients(x, y)[1].values())


def test_scores_all_too_small_for_a_power_of_e():
    """Every chance but one class's vanishes, and that class's logit is far below zero too."""
    model = attention.Attention.new(7)
    model.p["bias"] -= 200
    classes = np.random.default_rng(4).integers(0, 7, 40)
    x, y = attention.windows(classes, 7, 8)
    got = model.tables().log_chances(x, y)
    assert got[y >= 0] == pytest.approx(naive(attention.Attention.new(7), classes), abs=1e-3)
    assert all(np.isfinite(g).all() for g in model.gradients(x, y)[1].values())


def test_spelling_a_text_takes_room_for_that_text_alone():
    """Not for all words of its chunk, which were gone through for each of its texts."""
    n = 200_000
    lengths = np.arange(n) % 3
    ids = np.arange(lengths.sum()).astype("<u2")
    row = {
        "chunk": 0, "doc_ids": [1], "held": [False], "c": np.ones(n, "<i8").tobytes(),
        "sizes": np.array([5], "<i4").tobytes(), "places": np.arange(5, dtype="<i4").tobytes(),
        "lengths": lengths.astype("<u4").tobytes(), "ids": ids.tobytes(),
    }
    chunk = next(language_model.Chunk.each(iter([pa.RecordBatch.from_pylist([row])])))
    at = np.array([5, 0, 199_999, 5, 4])
    tracemalloc.start()
    found = chunk.spelled(at)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    begins = np.cumsum(lengths) - lengths
    assert found.tolist() == [int(ids[begins[w] + i]) for w in at for i in range(lengths[w])]
    assert most < 100_000


def test_parts_learn_what_ids_go_together(spark):
    """Two kinds of texts, in several parts: their ids get different topics."""
    rng = np.random.default_rng(5)
    size = 60
    kinds = [rng.integers(0, 30, 40) + 30 * (i % 2) for i in range(300)]
    rows = [(i % 3, bytearray(ids.astype("<u2").tobytes())) for i, ids in enumerate(kinds)]
    sample = spark.createDataFrame(rows, "part long, ids binary")
    counts = np.bincount(np.concatenate(kinds), minlength=size).astype(float)
    topic = language_model.topics(sample, counts)
    assert not set(topic[:30]) & set(topic[30:])


def test_subword_ids_equal_the_tokenizers(spark):
    from tests.llm.rows import odd_rows

    assert os.path.exists(language_model.TOKENIZER)
    encoder = subwords()
    texts = [row[1] for row in odd_rows()] + [
        "Don't we've o'clock!!! ÉCOLE naïve Straße ΣΑΣ H̱ áb <|endoftext|> a,b;c 12ab ŉ Ǆ",
    ]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    for text, ids in zip(texts, encoder.ids(texts)):
        plain = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == plain


def test_cases_and_marks_of_a_word_are_encoded_once():
    encoder = Subwords()
    encoder.ids(["Stone stONE stone stone### Stone*** (not) STONE_"])
    assert list(encoder._plain) == ["stone"]


def test_words_of_a_bucket_are_not_kept():
    """They are distinct, so no word is asked for again."""
    words = ["stone", "stones***", "caf\u00e9", "(not)", "12", "\u1e96", "don't"]
    kept = len(subwords()._known)
    bucket = pa.table(
        {
            "chunk": [0], "bucket": [0], "words": ["\n".join(words).encode()],
            "counts": [np.ones(len(words), "<i8").tobytes()],
        }
    )
    answers = language_model._answers(language_model.TOKENIZER)(bucket)
    ids = np.frombuffer(answers.column("ids")[0].as_py(), "<u2").tolist()
    encoder = subwords()
    plain = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert ids == sum(plain, [])
    assert np.frombuffer(answers.column("lengths")[0].as_py(), "<u4").tolist() == [len(x) for x in plain]
    assert len(encoder._known) == kept


def test_ids_where_case_and_composed_marks_meet():
    texts = [
        "J\u030c \u01f0 H\u0331 T\u0308 W\u030a Y\u030a I\u0307 A\u030a J\u0323\u030c",
        "ABC<|ENDOFTEXT|> x<|endoftext|>Y <|StartOfText|>",
        "Don'T WE'VE 'S it's### X're' ABC's'S \u00e9''s \u00c9!!! a#\u0338 A=\u0338",
    ]
    encoder = Subwords()
    for text, ids in zip(texts, encoder.ids(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
