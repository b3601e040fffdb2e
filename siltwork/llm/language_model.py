"""Score texts by a causal self-attention model on subword ids.

Words of training documents are counted over the whole corpus; the ids of a word
come from the tokenizer, once per distinct word, so the counts of subword ids
follow from those of words. Ids are put into ``CLASSES`` classes: by the texts
they occur in together, by whether they end a word, and in bands of frequency.
The attention model gives the chance of an id's class from the ids before it.
Windows of a text overlap and score each id once, in batches.

The chance of a word is that of its first id's class, given by attention, times
the word's share of the class: its count, less ``DISCOUNT``, of all words that
begin in the class. What is discounted, and a share ``SPELLED``, goes to words
spelled by subwords: the chance of the first id in its class, by counts plus one,
then that of each further id, its class by attention. A text's probability is the
product over its words and the end. A word that the tokenizer gives no ids has
the chance of its count plus one.

The model is trained in numpy on all training documents. Each chunk goes on from the
same parameters, and these are averaged, by what they were trained on, after each of
``ROUNDS`` rounds; a round takes every ``ROUNDS``-th training text of a chunk and each of
its windows once, so that all rounds together take every window. Topics of ids come
from sums over all training texts. Neither texts nor ids reach the driver, only
parameters and sums by id.

Documents are cut into chunks of about ``CHUNK`` bytes of whole texts. A chunk numbers
its distinct words, and lists them once for each bucket of words; a bucket adds up what
chunks count and answers each with counts and ids in the order of its list, so
that words move once, and not back. Texts go on as the numbers of their words, meet the
answers once, and are then read where they lie.

Null texts count as empty and have the end only. Repeated rows are scored one by
one, null ids are trained on. Texts may be of any length, one is never divided.
Other columns are not read. Without training documents the counts are empty and
the model is as it was drawn. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.attention import Attention, Scorer, keep_room, windows
from siltwork.llm.subwords import TOKENIZER, small_slices, subwords
from siltwork.llm.text import fold
from siltwork.session import write_out

FOLDS, HELD_OUT = 7, 2
CLASSES, TOPICS = 64, 6
#: Ids that topics are found for: the commonest; and the numbers that describe one.
_WITH_TOPIC, _TRAITS = 6000, 32
SPELLED, DISCOUNT = 0.02, 0.75
CHUNK = 12_000_000
#: Bytes of text for each bucket of words.
BUCKET = 16_000_000
#: One in so many training texts is learned from.
ONE_IN = 1
ROUNDS, LEAST_STEPS = 4, 500
BATCH = 96
#: Stands for the end of a text among words, which are never empty.
END = b""
_AT_ONCE = 256


class _Places(dict):
    """Numbers words in the order in which they are first looked up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Numbers of the words of a text and of its end."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        words.append(END)
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words, bucket after bucket, and the bucket of each."""
        bucket = np.fromiter(map(crc32, self), np.uint32, len(self)) % buckets
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]


_CHUNKED = (
    "chunk bigint, doc_ids array<bigint>, held array<boolean>, sizes binary, places binary, "
    "order binary, bucket int, words binary, counts binary"
)


def _chunked(buckets: int):
    """Arrow function: a row for each chunk, and its distinct words by bucket.

    Words have numbers by their first occurrence; a chunk has those of its texts, one
    text after the other, and those of its lists. Lists have counts in training documents.
    """

    def listed(
        chunk: int, names: list[bytes], doc_ids: list, held: list, texts: list[np.ndarray],
        order: np.ndarray, bucket: np.ndarray,
    ) -> pa.RecordBatch:
        counts = np.zeros(len(names), dtype="<i8")
        trained = [at for at, out in zip(texts, held) if not out]
        if trained:
            counts += np.bincount(np.concatenate(trained), minlength=len(names))
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets).astype(bool))
        spans = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        n = len(spans)
        sizes = np.fromiter(map(len, texts), "<i4", len(texts))

        def once(value, kind: pa.DataType) -> pa.Array:
            return pa.array([value, *[None] * n], kind)

        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, chunk)),
                once(doc_ids, pa.list_(pa.int64())),
                once(held, pa.list_(pa.bool_())),
                once(sizes.tobytes(), pa.binary()),
                once(np.concatenate(texts).astype("<i4").tobytes(), pa.binary()),
                once(order.astype("<i4").tobytes(), pa.binary()),
                pa.array([None, *bucket[cuts[:-1]].tolist()], pa.int32()),
                pa.array([None, *(b"\n".join([names[i] for i in span]) for span in spans)], pa.binary()),
                pa.array([None, *(counts[span].tobytes() for span in spans)], pa.binary()),
            ],
            names=_NAMES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 20, 0
        places, doc_ids, held, texts = _Places(), [], [], []
        for part in small_slices(batches, "text"):
            doc_ids += part.column("doc_id").to_pylist()
            held += part.column("held_out").to_pylist()
            texts += map(places.of, part.column("text").to_pylist())
            size += part.column("text").nbytes
            if size >= CHUNK:
                yield listed(chunk, list(places), doc_ids, held, texts, *places.by_bucket(buckets))
                chunk, size = chunk + 1, 0
                places, doc_ids, held, texts = _Places(), [], [], []
        if texts:
            yield listed(chunk, list(places), doc_ids, held, texts, *places.by_bucket(buckets))

    return run


_NAMES = [column.split()[0] for column in re.split(", (?=[a-z_]+ )", _CHUNKED)]
_ANSWERS = "chunk bigint, bucket int, c binary, lengths binary, ids binary"


def _answers(path: str):
    """Arrow function of a bucket: per chunk, counts and ids of its words in their order.

    One row more, of chunk -1, sums over the bucket's words of training documents: per
    id how often it occurs, how often it begins a word, and how many words it begins.
    Words without ids are summed under the number of ids.
    """

    def run(bucket: pa.Table) -> pa.Table:
        encoder = subwords(path)
        places = _Places()
        rows = []
        for words in bucket.column("words").to_pylist():
            names = words.split(b"\n")
            rows.append(np.fromiter(map(places.__getitem__, names), np.int32, len(names)))
        total = np.zeros(len(places), dtype="<i8")
        for at, counts in zip(rows, bucket.column("counts").to_pylist()):
            total[at] += np.frombuffer(counts, dtype="<i8")
        end = np.array([encoder.size - 1], dtype="<u2").tobytes()
        raw = [
            end if w == END else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
            for w, ids in zip(places, encoder.distinct(list(places)))
        ]
        lengths = (np.fromiter(map(len, raw), np.int64, len(raw)) // 2).astype("<u4")
        ids = np.frombuffer(b"".join(raw), dtype="<u2")
        first = np.full(len(raw), encoder.size)
        some = lengths > 0
        first[some] = ids[(np.cumsum(lengths) - lengths)[some]]
        seen = total > 0
        sums = np.zeros((3, encoder.size + 1), dtype="<i8")
        np.add.at(sums[0], ids, np.repeat(total, lengths))
        np.add.at(sums[1], first, total)
        np.add.at(sums[2], first[seen], 1)
        used = np.flatnonzero(sums[1] + sums[0])
        n = len(rows)
        return pa.table(
            {
                "chunk": pa.array([*bucket.column("chunk").to_pylist(), -1], pa.int64()),
                "bucket": pa.array([*bucket.column("bucket").to_pylist(), None], pa.int32()),
                "c": pa.array([*(total[at].tobytes() for at in rows), sums[:, used].tobytes()], pa.binary()),
                "lengths": pa.array([*(lengths[at].tobytes() for at in rows), b""], pa.binary()),
                "ids": pa.array(
                    [*(b"".join([raw[i] for i in at]) for at in rows), used.astype("<u2").tobytes()],
                    pa.binary(),
                ),
            }
        )

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the sums over buckets."""
    for batch in batches:
        for ids, c in zip(batch.column("ids").to_pylist(), batch.column("c").to_pylist()):
            found = np.frombuffer(ids, dtype="<u2").astype(np.int64)
            n, first, words = np.frombuffer(c, dtype="<i8").reshape(3, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (found, n, first, words)],
                names=["id", "n", "first", "words"],
            )


@dataclass(frozen=True)
class Counted:
    """Sums over all training documents, by id; the last place is of words without ids."""

    n: np.ndarray
    first: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(answers: DataFrame, size: int) -> Counted:
        sums = answers.where("chunk = -1").mapInArrow(_sums, "id bigint, n bigint, first bigint, words bigint")
        total = np.zeros((3, size + 1))
        by_id = sums.groupBy("id").agg(*(F.sum(c).alias(c) for c in ("n", "first", "words")))
        for row in by_id.collect():
            total[:, row["id"]] = row["n"], row["first"], row["words"]
        return Counted(*total)

    @property
    def tokens(self) -> int:
        return int(self.first.sum())

    @property
    def distinct(self) -> int:
        return int(self.words.sum())


_READ = (
    "chunk bigint, doc_ids array<bigint>, held array<boolean>, sizes binary, places binary, "
    "c binary, lengths binary, ids binary"
)


def _met(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's row with counts and ids of its words, in the order of their numbers."""
    answers = answers.sort_by("bucket")

    def answered(column: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(answers.column(column).to_pylist()), dtype=kind)

    order = np.frombuffer(docs.column("order")[0].as_py(), dtype="<i4")
    asked = np.empty_like(order)
    asked[order] = np.arange(len(order))
    lengths = answered("lengths", "<u4")
    long = lengths.astype(np.int64)
    ids = answered("ids", "<u2")[_spans(np.cumsum(long) - long, long[asked], asked)]
    made = [answered("c", "<i8")[asked], lengths[asked], ids]
    for name, values in zip(("c", "lengths", "ids"), made):
        docs = docs.append_column(name, pa.array([values.tobytes()], pa.binary()))
    return docs.drop_columns(["order"])


def _spans(begins: np.ndarray, long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of what stands in the spans numbered ``at``, one after the other.

    ``begins`` are those of all spans; ``long`` is how long those in ``at`` are.
    """
    ends = np.cumsum(long)
    return np.arange(long.sum()) + np.repeat(begins[at] - ends + long, long)


@dataclass(frozen=True)
class Chunk:
    """Texts of a chunk as numbers of words, with counts and ids of its words."""

    number: int
    doc_ids: pa.Array
    held: np.ndarray
    texts: list[np.ndarray]
    c: np.ndarray
    lengths: np.ndarray
    begins: np.ndarray
    ids: np.ndarray

    @staticmethod
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
        for batch in batches:
            for i in range(batch.num_rows):
                def values(column: str, kind: str) -> np.ndarray:
                    return np.frombuffer(batch.column(column)[i].as_buffer(), dtype=kind)

                ends = np.cumsum(values("sizes", "<i4").astype(np.int64))
                lengths = values("lengths", "<u4").astype(np.int64)
                yield Chunk(
                    batch.column("chunk")[i].as_py(),
                    batch.column("doc_ids")[i].values,
                    np.array(batch.column("held")[i].as_py(), dtype=bool),
                    np.split(values("places", "<i4"), ends[:-1]),
                    values("c", "<i8"),
                    lengths,
                    np.cumsum(lengths) - lengths,
                    values("ids", "<u2"),
                )

    def spelled(self, at: np.ndarray) -> np.ndarray:
        """Ids of words, one word after the other."""
        return self.ids[_spans(self.begins, self.lengths[at], at)]


def _learned(
    batches: Iterator[pa.RecordBatch], turn: int | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """Parts and ids of training texts: those of a round, or all.

    Rows are chunks, which are parts of their own, or texts with their ``part`` and ``ids``;
    rows of a part follow each other.
    """
    for batch in batches:
        if "part" in batch.schema.names:
            rows = zip(batch.column("part").to_pylist(), batch.column("ids").to_pylist())
            for i, (part, raw) in enumerate(rows):
                if turn is None or i % ROUNDS == turn:
                    yield part, np.frombuffer(raw, dtype="<u2")
            continue
        for chunk in Chunk.each([batch]):
            training = [at for at, out in zip(chunk.texts, chunk.held) if not out]
            for at in training if turn is None else training[turn::ROUNDS]:
                yield chunk.number, chunk.spelled(at)


@dataclass(frozen=True)
class Model:
    """Class of each id, log chance of the id in its class, the trained model.

    Per class: how many words of training documents begin in it, and the log of what
    it leaves to words that are spelled.
    """

    class_of: np.ndarray
    within: np.ndarray
    begun: np.ndarray
    left: np.ndarray
    scorer: Scorer

    def words(self, texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Natural log of the chance of each word that has ids.

        A text is its ids, the lengths of its words and their counts.
        """
        inputs, targets = [], []
        for ids, _, _ in texts:
            a, b = windows(self.class_of[ids], CLASSES, CLASSES + 1)
            inputs.append(a)
            targets.append(b)
        x, y = np.concatenate(inputs), np.concatenate(targets)
        found = np.empty(y.shape)
        for at in range(0, len(x), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            found[part] = self.scorer.log_chances(x[part], y[part])
        ids = np.concatenate([ids for ids, _, _ in texts])
        lengths = np.concatenate([lengths for _, lengths, _ in texts]).astype(np.int64)
        counts = np.concatenate([counts for _, _, counts in texts])
        class_chance = found[y >= 0]
        starts = np.cumsum(lengths) - lengths
        lead = class_chance[starts]
        each = class_chance + self.within[ids]
        spelled = np.add.reduceat(each, starts) - lead if len(starts) else lead
        begins = self.class_of[ids[starts]]
        share = np.maximum(counts - DISCOUNT, 0) * (1 - SPELLED) / np.maximum(self.begun[begins], 1)
        with np.errstate(divide="ignore"):
            return lead + np.logaddexp(np.log(share), self.left[begins] + spelled)


def _common(counts: np.ndarray) -> np.ndarray:
    found = np.argsort(-counts, kind="stable")[:_WITH_TOPIC]
    return found[counts[found] > 0]


def _directions(n: int) -> np.ndarray:
    return np.random.default_rng(29).normal(0, _TRAITS**-0.5, (n, _TRAITS))


_TRAIT_NAMES = [f"t{i}" for i in range(_TRAITS)]
_TRAIT_SUMS = [*_TRAIT_NAMES, "weight", "own"]


def _traits(common: np.ndarray, size: int):
    """Arrow function: per common id the sum of the traits of its texts.

    Each id has a random direction; a text's traits are the sum of those of its ids,
    by the root of their share of the text. Place -1 sums the texts' traits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids that are not common share a place after the others.
        place = np.full(size, len(common))
        place[common] = np.arange(len(common))
        directions = _directions(len(common))
        sums = np.zeros((len(common) + 1, _TRAITS + 2))
        for _, ids in _learned(batches):
            n = np.bincount(place[ids], minlength=len(common) + 1)[:-1]
            at = np.flatnonzero(n)
            share = n[at] / max(len(ids), 1)
            root = np.sqrt(share)
            traits = root @ directions[at]
            sums[at, :_TRAITS] += root[:, None] * traits
            sums[at, _TRAITS] += root
            sums[at, _TRAITS + 1] += share
            sums[-1, :_TRAITS] += traits
            sums[-1, _TRAITS] += 1
        used = np.flatnonzero(sums[:, _TRAITS])
        names = np.where(used == len(common), -1, used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), *(pa.array(sums[used, i]) for i in range(_TRAITS + 2))],
            names=["place", *_TRAIT_SUMS],
        )

    return run


def topics(sample: DataFrame, counts: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Topic of each id: ids that occur in like texts; the last one for rare ids."""
    found = np.full(len(counts), TOPICS)
    common = _common(counts)
    schema = "place bigint, " + ", ".join(f"{c} double" for c in _TRAIT_SUMS)
    parts = sample.mapInArrow(_traits(common, len(counts)), schema)
    rows = parts.groupBy("place").agg(*(F.sum(c).alias(c) for c in _TRAIT_SUMS)).collect()
    rows = {row["place"]: np.array([row[c] for c in _TRAIT_SUMS]) for row in rows}
    if -1 not in rows:
        return found
    texts = rows.pop(-1)
    places = np.array(sorted(rows), dtype=np.int64)
    sums = np.array([rows[p] for p in places]).reshape(len(places), _TRAITS + 2)
    # What an id adds to its own texts, and what all texts have, tell nothing of it.
    table = sums[:, :_TRAITS] - sums[:, _TRAITS + 1 :] * _directions(len(common))[places]
    table -= sums[:, _TRAITS : _TRAITS + 1] * texts[:_TRAITS] / texts[_TRAITS]
    # Sums of parts may come in another order, which the last digits show.
    table = table.round(6)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    seen = norm[:, 0] > 1e-5
    table = table[seen] / norm[seen]
    if len(table) <= TOPICS:
        return found
    centres = [table[0]]
    for _ in range(TOPICS - 1):
        nearest = np.max([table @ c for c in centres], axis=0)
        centres.append(table[int(np.argmin(nearest))])
    centres = np.array(centres)
    for _ in range(rounds):
        topic = (table @ centres.T).argmax(axis=1)
        for t in range(TOPICS):
            if (topic == t).any():
                mean = table[topic == t].sum(axis=0)
                centres[t] = mean / max(np.linalg.norm(mean), 1e-9)
    found[common[places[seen]]] = topic
    return found


def classes_of(counts: np.ndarray, topic: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id and the natural log of its chance in the class."""
    smooth = counts + 1.0
    group = topic * 2 + ends
    kinds = 2 * (TOPICS + 1)
    share = np.bincount(group, smooth, kinds) / smooth.sum()
    bands = 1 + (share * (CLASSES - kinds)).astype(int)
    class_of = np.zeros(len(counts), dtype=np.uint8)
    first = 0
    for kind in range(kinds):
        ids = np.flatnonzero(group == kind)
        ids = ids[np.argsort(-counts[ids], kind="stable")]
        if len(ids):
            weight = np.cumsum(smooth[ids])
            band = ((weight - smooth[ids] / 2) / weight[-1] * bands[kind]).astype(int)
            class_of[ids] = first + np.minimum(band, bands[kind] - 1)
        first += bands[kind]
    total = np.bincount(class_of, smooth, CLASSES)
    return class_of, np.log(smooth / total[class_of])


def _encoded(path: str):
    """Arrow function: subword ids of texts, two bytes each, and of their end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(path)
        end = np.array([encoder.size - 1], dtype="<u2").tobytes()
        for part in small_slices(batches, "text"):
            texts = encoder.ids(part.column("text").to_pylist())
            rows = [ids.astype("<u2").tobytes() + end for ids in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("part"), pa.array(rows, pa.binary())], names=["part", "ids"]
            )

    return run


def sampled(texts: DataFrame, path: str) -> DataFrame:
    """Part and ids of all training texts, for a model of texts that are not in chunks."""
    training = texts.where(~F.col("held_out")).select(F.col("chunk").alias("part"), "text")
    return training.mapInArrow(_encoded(path), "part bigint, ids binary")


def _round(model: Attention, class_of: np.ndarray, number: int):
    """Arrow function: parameters after a round on each part's windows, and their weight.

    What a task makes of its parts is added up.
    """
    def after(part: int, texts: Iterator[np.ndarray]) -> tuple[np.ndarray, float]:
        pairs = [windows(class_of[ids], CLASSES, CLASSES + 1) for ids in texts]
        inputs = np.concatenate([a for a, _ in pairs])
        targets = np.concatenate([b.astype(np.int8) for _, b in pairs])
        own = Attention(model.classes, {name: v.copy() for name, v in model.p.items()})
        steps = max(LEAST_STEPS // ROUNDS, -(-len(inputs) // BATCH))
        own.train(
            inputs, targets, steps, part * ROUNDS + number, BATCH, number / ROUNDS, (number + 1) / ROUNDS
        )
        return own.flat().astype(np.float64) * len(inputs), float(len(inputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = 0.0, 0.0
        for part, rows in groupby(_learned(batches, number), itemgetter(0)):
            value, n = after(part, (ids for _, ids in rows))
            total, weight = total + value, weight + n
        if weight:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(total))), pa.array(total),
                    pa.array(np.full(len(total), weight)),
                ],
                names=["place", "value", "weight"],
            )

    return run


def trained(sample: DataFrame, counted: Counted, path: str) -> Model:
    """A model fitted on training documents, part by part; rows as ``_learned`` takes them."""
    encoder = subwords(path)
    counts = counted.n[:-1]
    class_of, within = classes_of(counts, topics(sample, counts), encoder.ends())
    model = Attention.new(CLASSES)
    for number in range(ROUNDS):
        parts = sample.mapInArrow(
            _round(model, class_of, number), "place bigint, value double, weight double"
        )
        mean = parts.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value"))
        rows = mean.orderBy("place").collect()
        if rows:
            model = model.with_flat(np.round([row["value"] for row in rows], 7))
    begun = np.bincount(class_of, counted.first[:-1], CLASSES)
    words = np.bincount(class_of, counted.words[:-1], CLASSES)
    free = np.where(begun > 0, DISCOUNT * words / np.maximum(begun, 1), 1.0)
    left = np.log(SPELLED + (1 - SPELLED) * free)
    return Model(class_of, within.astype(np.float32), begun, left, model.tables())


def _scored(model: Model, n: int, v: int):
    """Arrow function: scores of the documents of chunks."""
    floor = float(np.log10(n + v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_room()
        for chunk in Chunk.each(batches):
            logs, known, some = np.log10(chunk.c + 1.0), chunk.c > 0, chunk.lengths > 0
            sizes = np.fromiter(map(len, chunk.texts), np.int64, len(chunk.texts))
            start = 0
            while start < len(sizes):
                # About 50,000 words at once, a text at least.
                stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), 50_000, "right")))
                texts, size = chunk.texts[start:stop], sizes[start:stop]
                spelled = []
                for at in texts:
                    at = at[some[at]]
                    spelled.append((chunk.spelled(at), chunk.lengths[at], chunk.c[at]))
                at = np.concatenate(texts)
                begins = np.cumsum(size) - size
                base = np.add.reduceat(logs[at], begins) - size * floor
                each = logs[at] - floor
                each[some[at]] = model.words(spelled) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.doc_ids[start:stop],
                        pa.array(chunk.held[start:stop]),
                        pa.array(size),
                        pa.array(np.add.reduceat(known[at].astype(np.int64), begins)),
                        pa.array(np.full(len(size), n)),
                        pa.array(base),
                        pa.array(np.add.reduceat(each, begins)),
                    ],
                    names=_SCORE_NAMES,
                )
                start = stop

    return run


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)
_SCORE_NAMES = [column.split()[0] for column in _SCORES.split(", ")]


def scored(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "text",
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // BUCKET
    chunks = write_out(rows.mapInArrow(_chunked(buckets), _CHUNKED), "lm-chunks", "zstd")
    texts = chunks.where("bucket IS NULL").drop("bucket", "words", "counts")
    words = chunks.where("bucket IS NOT NULL").select("chunk", "bucket", "words", "counts")
    answers = write_out(
        words.groupBy("bucket").applyInArrow(_answers(tokenizer), _ANSWERS), "lm-answers", "zstd"
    )
    counted = Counted.of(answers, subwords(tokenizer).size)
    met = texts.groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk"))
    read = write_out(met.applyInArrow(_met, _READ), "lm-read", "zstd")
    model = trained(read, counted, tokenizer)
    return read.mapInArrow(_scored(model, counted.tokens, counted.distinct), _SCORES)
