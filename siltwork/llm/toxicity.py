"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other.
Small transducers rewrite a clause's symbols one after the other: negation takes
back what follows it closely, reporting verbs turn what follows into quoted
speech, and a target before an insult or threat makes it directed. They are
composed into one machine; a second one reads its output backwards, as a target
after an insult directs it too. A threat mostly names its target after it, so there
that tells nothing. What they put out for whole clauses, not single words, is
counted and weighed.

Insults are stems. Beside a few fixed ones, stems are learned: word beginnings
that occur in many toxic texts and hardly in others, counted over at most about
``MOST_TEXTS`` labelled texts, equal texts once; of nested ones the shortest
stays, ``MOST_STEMS`` in all. Logistic regression on the clause counts of the
same texts sets the weights.

Null and empty texts have no clauses and get the score of none. Repeated rows are
scored one by one. Without labels of both kinds only the fixed stems count, with
fixed weights. Only id and text are read of documents, id and toxic of labels;
of labels that name an id twice the higher one counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.samples import share_of
from siltwork.llm.subwords import small_slices
from siltwork.llm.text import fold, whole
from siltwork.session import write_out

MOST_TEXTS = 20_000
MOST_STEMS = 400
#: A stem must occur in so many toxic texts, and in that share of them.
LEAST_TEXTS, LEAST_SHARE = 12, 0.02
LEAST_RATIO = 30.0
PREDICTED_FROM = 0.3
_FOLDS, _HELD_OUT = 4, 2
_SHORTEST, _LONGEST = 4, 9

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "ITPNRO"
#: What the composed machine puts out: plain, directed, quoted and taken back.
OUTPUTS = ("I", "T", "i", "t", "q", "n")
# Words with a known part in a clause.
INSULTS = ("idiot", "moron", "scum", "stupid", "worthless", "pathetic", "loser", "imbecile")
THREATS = ("kill", "hurt", "destroy", "murder", "strangle", "stab", "shoot", "beat")
TARGETS = ("you", "your", "u", "they", "them", "he", "she", "him", "her", "these", "those", "people")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "don't", "doesn't", "nobody", "without")
REPORTS = ("said", "says", "claimed", "wrote", "called", "quoted", "reported", "quote", "allegedly")

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:,\n]+")

Machine = dict[tuple[str, str], tuple[str, str]]


def window_machine(opens: str, length: int, rewrites: dict[str, str]) -> Machine:
    """Rewrites symbols within ``length`` words after one of ``opens``."""
    symbols = {*"ITPNRO", *OUTPUTS}
    made: Machine = {}
    for left in range(length + 1):
        for symbol in symbols:
            after = length if symbol == opens else max(left - 1, 0)
            made[str(left), symbol] = (str(after), rewrites.get(symbol, symbol) if left else symbol)
    return made


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that puts the output of ``first`` into ``second``."""
    made: Machine = {}
    for (state, symbol), (after, out) in first.items():
        for other, read in second:
            if read == out:
                then, result = second[other, out]
                made[f"{state}|{other}", symbol] = (f"{after}|{then}", result)
    return made


def grammar() -> Machine:
    """Negation, then reported speech, then targets."""
    negation = window_machine(NEGATION, 3, {INSULT: "n", THREAT: "n"})
    report = window_machine(REPORT, 12, {INSULT: "q", THREAT: "q"})
    target = window_machine(TARGET, 4, {INSULT: "i", THREAT: "t"})
    return compose(compose(negation, report), target)


@dataclass(frozen=True)
class Lexicon:
    """Stems of insults with their weights."""

    stems: dict[str, float]

    def parts(self) -> tuple[dict[str, str], dict[str, float], frozenset[str], tuple[int, ...]]:
        fixed = dict.fromkeys(TARGETS, TARGET) | dict.fromkeys(NEGATIONS, NEGATION)
        fixed |= dict.fromkeys(REPORTS, REPORT) | dict.fromkeys(THREATS, THREAT)
        heads = frozenset(stem[:_SHORTEST] for stem in self.stems)
        return fixed, self.stems, heads, tuple(sorted({len(stem) for stem in self.stems}))


class Scorer:
    """Counts of clause outputs of a text."""

    def __init__(self, lexicon: Lexicon):
        self.fixed, self.stems, self.heads, self.lengths = lexicon.parts()
        self.machine = grammar()
        self.start = "0|0|0"
        self.back = window_machine(TARGET, 4, {INSULT: "i"})

    def _stem(self, word: str) -> float:
        if word[:_SHORTEST] in self.heads:
            for length in self.lengths:
                if word[:length] in self.stems:
                    return self.stems[word[:length]]
        return 0.0

    def counts(self, text: str | None) -> np.ndarray:
        """Per output the clauses that have it, then the weight of stems, all as log1p."""
        found = np.zeros(len(OUTPUTS) + 1)
        lower = (text or "").lower()
        words = set(_WORD.findall(lower))
        heavy = {w: s for w in words if (s := self._stem(w))}
        if heavy or not words.isdisjoint(THREATS):
            for clause in _CLAUSE.split(lower):
                tokens = _WORD.findall(clause)
                if heavy.keys().isdisjoint(tokens) and set(tokens).isdisjoint(THREATS):
                    continue
                state, outs, seen = self.start, [], set()
                for token in tokens:
                    symbol = INSULT if token in heavy else self.fixed.get(token, OTHER)
                    state, out = self.machine[state, symbol]
                    outs.append(out)
                    if out in "Ii":
                        found[-1] += heavy[token]
                state = "0"
                for out in reversed(outs):
                    state, out = self.back[state, out]
                    seen.add(out)
                for at, out in enumerate(OUTPUTS):
                    found[at] += out in seen
        return np.log1p(found)


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...]
    bias: float

    def score(self, counts: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(np.dot(counts, self.weights) + self.bias))))


#: Without labels: directed forms weigh most, taken back and quoted ones little.
UNFITTED = (1.5, 1.5, 2.5, 3.0, 0.2, 0.1, 0.5)


def shares(counts: dict[int, int], most: int) -> dict[int, float]:
    """Share of each label's documents to take: half of ``most``, or what the other leaves."""
    found = {}
    for label in (0, 1):
        own, other = counts.get(label, 0), counts.get(1 - label, 0)
        found[label] = min(1.0, max(most / 2, most - other) / max(own, 1))
    return found


def _labelled(
    docs: DataFrame, labels: DataFrame, most_texts: int
) -> tuple[DataFrame, dict[int, float]]:
    """Rows (text, toxic) of about ``most_texts`` labelled documents, equal texts once.

    Also the share that was taken of each label.
    """
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(fold("doc_id", _FOLDS) != _HELD_OUT)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = write_out(rows, "toxic-labels")
    counts = rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    taken = shares({row["toxic"]: row["n"] for row in counts}, most_texts)
    share = F.when(F.col("toxic") == 1, taken[1]).otherwise(taken[0])
    some = rows.where(share_of("doc_id", 9) < share)
    texts = docs.select("doc_id", "text").where(share_of("doc_id", 9) < max(taken.values()))
    found = texts.join(F.broadcast(write_out(some, "toxic-sample")), "doc_id")
    texts = write_out(
        found.groupBy(F.md5(whole("text")).alias("__digest")).agg(
            F.max("toxic").alias("toxic"), F.first("text").alias("text")
        ),
        "toxic-texts",
    )
    return texts, taken


def learned_stems(texts: DataFrame, most: int = MOST_STEMS) -> dict[str, float]:
    """Word beginnings that mark toxic texts, with the log of how much they do."""
    sizes = {row["toxic"]: row["n"] for row in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}
    words = F.array_distinct(F.regexp_extract_all(F.lower(whole("text")), F.lit(r"\p{L}+"), F.lit(0)))
    by_word = (
        texts.select("toxic", F.explode(words).alias("word"))
        .where(F.length("word") >= _SHORTEST)
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    longest = F.least(F.length("word"), F.lit(_LONGEST))
    stems = F.transform(F.sequence(F.lit(_SHORTEST), longest), lambda n: F.substr("word", F.lit(1), n))
    by_stem = (
        by_word.select(F.explode(stems).alias("stem"), "bad", "good")
        .groupBy("stem")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    ratio = ((F.col("bad") + 0.5) / sizes[1]) / ((F.col("good") + 0.5) / sizes[0])
    least = max(LEAST_TEXTS, LEAST_SHARE * sizes[1])
    rows = (
        by_stem.where((F.col("bad") >= least) & (ratio >= LEAST_RATIO))
        .select("stem", F.log(ratio).alias("weight"), "bad")
        .orderBy(F.desc("bad"), F.length("stem"), "stem")
        .limit(most * _LONGEST)
        .collect()
    )
    found: dict[str, float] = {}
    for row in sorted(rows, key=lambda r: (len(r["stem"]), -r["bad"], r["stem"])):
        stem = row["stem"]
        if len(found) < most and not any(stem[:n] in found for n in range(_SHORTEST, len(stem))):
            found[stem] = float(row["weight"])
    return found


def _arrow_counts(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in small_slices(batches, "text"):
            rows = [scorer.counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                names=["toxic", "counts"],
            )

    return run


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[tuple[float, ...], float]:
    """Weights and bias by Newton's method."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-rows @ w))
        slope = rows.T @ (p - y) / len(y) + penalty * w
        curve = (rows * (p * (1 - p))[:, None]).T @ rows / len(y) + penalty * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return tuple(float(v) for v in w[:-1]), float(w[-1])


def fitted(docs: DataFrame, labels: DataFrame, most_texts: int = MOST_TEXTS) -> Model:
    """A model from labelled documents that are not held out.

    Labels are sampled apart; the bias gives back how common each is.
    """
    texts, taken = _labelled(docs, labels, most_texts)
    stems = dict.fromkeys(INSULTS, 3.0) | learned_stems(texts)
    lexicon = Lexicon(stems)
    rows = texts.select("toxic", "text").mapInArrow(
        _arrow_counts(lexicon), "toxic int, counts array<double>"
    )
    grouped = rows.groupBy("counts", "toxic").agg(F.count("*").alias("n")).collect()
    if {row["toxic"] for row in grouped} != {0, 1}:
        return Model(lexicon, UNFITTED, -2.0)
    grouped.sort(key=lambda row: (row["counts"], row["toxic"]))
    x = np.repeat([row["counts"] for row in grouped], [row["n"] for row in grouped], axis=0)
    y = np.repeat([row["toxic"] for row in grouped], [row["n"] for row in grouped])
    weights, bias = logistic(x, y)
    return Model(lexicon, weights, bias + float(np.log(taken[0] / taken[1])))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        for batch in small_slices(batches, "text"):
            scores = [model.score(scorer.counts(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= PREDICTED_FROM) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (fold("doc_id", _FOLDS) == _HELD_OUT).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
