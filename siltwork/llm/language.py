"""Language by averaged embeddings of hashed subwords and a linear softmax.

A text is lower-cased; what is no letter separates words. The two, three and
four bytes from each place are hashed into ``BUCKETS``. A text's vector is the
mean of its buckets' embeddings, a linear layer and a softmax give
probabilities. Both are fitted by stochastic gradient descent in numpy on at most
about ``MOST_TEXTS`` whole texts, shared evenly between languages; a temperature
and the limit below which a prediction is ``rejected`` are set on texts kept from
the fit. As all layers are linear, embeddings times output weights are one table
of scores per bucket, which is what tasks use.

Texts without a letter, null ones included, are ``und`` with score 0. Repeated
rows are predicted one by one. If no row is labelled, all texts are ``und``. Of
the input only id, text and lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm.samples import share_of
from siltwork.llm.subwords import small_slices
from siltwork.llm.text import fold

UNKNOWN = "und"
BUCKETS = 1 << 12
WIDTH = 16
MOST_TEXTS = 2400
ACCURACY = 0.99
_FOLDS, _HELD_OUT = 4, 2
_LETTER = re.compile("[A-Za-z]")
_BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


def buckets(text: str) -> np.ndarray:
    """How often each bucket occurs among the text's hashed subwords."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_BLANKED) + b" "
    codes = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    gram, found = codes, []
    for size in (2, 3, 4):
        gram = gram[:-1] * np.uint32(0x01000193) + codes[size - 1 :]
        if not len(gram):
            break
        found.append((gram * np.uint32(0x9E3779B1) + np.uint32(size)) >> np.uint32(20))
    return np.bincount(np.concatenate(found), minlength=BUCKETS)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    limit: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, and whether it is too low to rely on."""
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = buckets(text)
        scores = (counts @ self.table / counts.sum() + self.bias) / self.temperature
        p = np.exp(scores - scores.max())
        best = int(p.argmax())
        score = float(p[best] / p.sum())
        return self.languages[best], score, score < self.limit


def _softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit(counts: np.ndarray, wanted: np.ndarray, languages: tuple[str, ...], seed: int = 5) -> Model:
    """Embeddings and output layer from rows of bucket counts and language numbers."""
    rng = np.random.default_rng(seed)
    x = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = x.astype(np.float32)
    n = len(languages)
    order = rng.permutation(len(x))
    kept = order[: len(x) // 5]
    used = order[len(x) // 5 :] if len(x) >= 5 else order
    embedding = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight = rng.normal(0, 0.1, (WIDTH, n)).astype(np.float32)
    bias = np.zeros(n, dtype=np.float32)
    epochs = 30
    for epoch in range(epochs):
        rate = np.float32(1.0 - epoch / epochs)
        used = rng.permutation(used)
        for at in range(0, len(used), 32):
            rows = used[at : at + 32]
            some = x[rows]
            hidden = some @ embedding
            error = _softmax(hidden @ weight + bias)
            error[np.arange(len(rows)), wanted[rows]] -= 1
            error /= len(rows)
            back = error @ weight.T
            weight -= rate * 2 * (hidden.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            embedding -= rate * 200 * (some.T @ back)
    table = embedding @ weight
    temperature, limit = 1.0, 0.0
    if len(kept):
        scores = x[kept] @ table + bias
        truth = wanted[kept]
        steps = np.geomspace(0.2, 5, 33)
        loss = [
            -np.log(_softmax(scores / t)[np.arange(len(kept)), truth] + 1e-9).mean() for t in steps
        ]
        temperature = float(steps[int(np.argmin(loss))])
        p = _softmax(scores / temperature)
        best, right = p.max(axis=1), p.argmax(axis=1) == truth
        falling = np.argsort(-best)
        good = np.cumsum(right[falling]) >= ACCURACY * np.arange(1, len(kept) + 1)
        limit = float(best[falling][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, table.astype(np.float32), bias, temperature, limit)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_slices(batches, "text"):
        texts = batch.column("text").to_pylist()
        rows = [buckets(text).astype("<u4").tobytes() for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(rows, pa.binary())], names=["lang", "counts"]
        )


def fitted(docs: DataFrame, most_texts: int = MOST_TEXTS) -> Model:
    """A model from labelled documents that are not held out."""
    labelled = docs.where(
        F.col("lang").isNotNull()
        & (F.col("lang") != UNKNOWN)
        & F.col("text").rlike(r"\p{L}")
        & (fold("doc_id", _FOLDS) != _HELD_OUT)
    )
    found = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(found))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    each = max(most_texts // len(languages), 1)
    share: Column = F.lit(0.0)
    for language, n in found.items():
        share = F.when(F.col("lang") == language, F.lit(min(1.0, each / n))).otherwise(share)
    some = labelled.where(share_of("doc_id", 3) < share).select("lang", "text")
    rows = some.mapInArrow(_counted, "lang string, counts binary").collect()
    rows.sort(key=lambda row: (row["lang"], bytes(row["counts"])))
    if not rows:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    counts = np.stack([np.frombuffer(row["counts"], dtype="<u4") for row in rows])
    wanted = np.array([languages.index(row["lang"]) for row in rows])
    return fit(counts, wanted, languages)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            found = [model.predict(text) for text in batch.column("text").to_pylist()]
            languages, scores, rejected = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(languages, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (fold("doc_id", _FOLDS) == _HELD_OUT).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    )
