"""Pack token sequences by non-negative least squares over length combinations.

A document's ids end with ``end_id``. Its whole windows are sequences of their
own; what is left over, shorter than a window, is packed with others. Only the
histogram of leftover lengths, at most ``window - 1`` counts, comes to the
driver. Combinations of up to three lengths that fill a window are listed, their
repeat counts are solved so that they use up the histogram (non-negative least
squares by multiplicative steps), rounded down, and what remains is packed
greedily, longest first. A sequence that would leave more than ``slack`` tokens
empty is cut at powers of two instead, where no padding is needed.

Which document takes which place follows from its number among the leftovers of
its length: numbers are counted per input partition and added up over the
partitions, so no task sees all documents of a length.

Null and empty texts hold only ``end_id``. Repeated rows and null ids are packed
one by one. Only id and text are read, so other columns cannot clash. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.subwords import TOKENIZER, small_slices, subwords
from siltwork.session import write_out

WINDOW = 4096
END_ID = 2
#: Cut documents up to this number are broadcast, each with at most a few ranges.
MOST_BROADCAST = 100_000
_PASSES = 300
_PARTNERS = 12

_COUNTED = (
    "doc_id bigint, __text bigint, __part int, doc_tokens bigint, __left int, __nth bigint, "
    "__full_from bigint, __full array<bigint>, __left_crc bigint"
)


@dataclass(frozen=True)
class Combination:
    """``lengths`` packed one after the other, ``repeats`` times."""

    lengths: tuple[int, ...]
    repeats: int


def _combinations(lengths: list[int], window: int) -> list[tuple[int, ...]]:
    """Pairs and triples of given lengths that fill the window, or come nearest to it."""
    found = set()

    def best(most: int) -> int | None:
        at = bisect_right(lengths, most)
        return lengths[at - 1] if at else None

    for a in lengths:
        b = best(window - a)
        if b is not None and a + b == window:
            found.add(tuple(sorted((a, b), reverse=True)))
        # Partners spread evenly over what fits, each with its best third.
        upto = bisect_right(lengths, window - a)
        for at in {int(upto * (i + 1) / (_PARTNERS + 1)) for i in range(_PARTNERS)}:
            if at < upto:
                c = best(window - a - lengths[at])
                if c is not None and a + lengths[at] + c == window:
                    found.add(tuple(sorted((a, lengths[at], c), reverse=True)))
    return sorted(found, reverse=True)


def _solve(combos: list[tuple[int, ...]], histogram: Counter, window: int) -> np.ndarray:
    """Repeats that bring the lengths used by ``combos`` nearest to the histogram."""
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.array([length for combo in combos for length in combo], dtype=np.int64)
    wanted = np.zeros(window + 1)
    for length, count in histogram.items():
        wanted[length] = count
    repeats = np.full(len(combos), 1.0)
    pull = np.bincount(column, wanted[row], len(combos))
    for _ in range(_PASSES):
        used = np.bincount(row, repeats[column], window + 1)
        repeats *= pull / np.maximum(np.bincount(column, used[row], len(combos)), 1e-12)
    return repeats


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[Combination]:
    """Combinations that use up exactly the lengths of ``histogram``."""
    left = Counter({length: n for length, n in histogram.items() if n > 0})
    made: list[Combination] = []

    def take(lengths: tuple[int, ...], repeats: int) -> None:
        need = Counter(lengths)
        repeats = min([repeats, *(left[length] // n for length, n in need.items())])
        if repeats > 0:
            made.append(Combination(lengths, repeats))
            for length, n in need.items():
                left[length] -= n * repeats

    combos = _combinations(sorted(left), window)
    if combos:
        solved = _solve(combos, left, window)
        for at in np.argsort(-solved, kind="stable"):
            if solved[at] < 1:
                break
            take(combos[at], int(solved[at]))
    lengths = sorted(length for length, n in left.items() if n > 0)
    while lengths:
        chosen, room, at = [], window, len(lengths)
        used: Counter = Counter()
        while at > 0:
            at = bisect_right(lengths, room, 0, at)
            while at > 0 and left[lengths[at - 1]] <= used[lengths[at - 1]]:
                at -= 1
            if at > 0:
                length = lengths[at - 1]
                chosen.append(length)
                used[length] += 1
                room -= length
        take(tuple(chosen), max(left.values()))
        lengths = [length for length in lengths if left[length] > 0]
    return made


def cuts(length: int, window: int, slack: int) -> list[int]:
    """Lengths of the sequences that ``length`` packed tokens are laid out as."""
    if window - length <= slack:
        return [length]
    return [1 << bit for bit in reversed(range(length.bit_length())) if length >> bit & 1]


def places(combos: Iterable[Combination], window: int, slack: int) -> list[tuple[int, ...]]:
    """Rows (left, first, last, piece_start, length, sequence, sequences, offset).

    The leftovers of length ``left`` numbered ``first`` to ``last`` have a piece
    of ``length`` from ``piece_start`` on; number n lies in the sequence
    ``sequence + (n - first) * sequences`` at ``offset``.
    """
    rows: list[tuple[int, ...]] = []
    used: Counter = Counter()
    sequence = 0
    for combo in combos:
        ends = np.cumsum(cuts(sum(combo.lengths), window, slack)).tolist()
        begin = 0
        for left in combo.lengths:
            first = used[left]
            used[left] += combo.repeats
            at = begin
            while at < begin + left:
                k = bisect_right(ends, at)
                end = min(ends[k], begin + left)
                start_of_sequence = ends[k - 1] if k else 0
                rows.append(
                    (left, first, used[left] - 1, at - begin, end - at, sequence + k, len(ends),
                     at - start_of_sequence)
                )
                at = end
            begin += left
        sequence += combo.repeats * len(ends)
    return rows


_PLACES = (
    "__left int, __first bigint, __last bigint, __piece_start bigint, length bigint, "
    "__sequence bigint, __sequences bigint, offset bigint"
)


def _counted(path: str, window: int, end_id: int):
    """Arrow function: per document its token count, pieces' digests and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = subwords(path), np.array([end_id], dtype="<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen: Counter = Counter()
        full_from = 0
        for batch in small_slices(batches, "text"):
            rows = {name: [] for name in ("n", "left", "nth", "from", "full", "crc")}
            for words in encoder.words(batch.column("text").to_pylist()):
                raw = b"".join(words) + end
                n = len(raw) // 4
                whole, left = divmod(n, window)
                step = 4 * window
                rows["n"].append(n)
                rows["left"].append(left)
                rows["nth"].append(seen[left])
                rows["from"].append(full_from)
                rows["full"].append([zlib.crc32(raw[i * step : (i + 1) * step]) for i in range(whole)])
                rows["crc"].append(zlib.crc32(raw[whole * step :]))
                seen[left] += 1
                full_from += whole
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("__text"),
                    pa.array([part] * size, pa.int32()),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["left"], pa.int32()),
                    pa.array(rows["nth"], pa.int64()),
                    pa.array(rows["from"], pa.int64()),
                    pa.array(rows["full"], pa.list_(pa.int64())),
                    pa.array(rows["crc"], pa.int64()),
                ],
                names=["doc_id", "__text", "__part", "doc_tokens", "__left", "__nth",
                       "__full_from", "__full", "__left_crc"],
            )

    return run


def _digested(path: str, end_id: int):
    """Arrow function: digests of ranges of ids of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = subwords(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in small_slices(batches, "text"):
            digests = []
            ranges = batch.column("__ranges").to_pylist()
            for words, wanted in zip(encoder.words(batch.column("text").to_pylist()), ranges):
                raw = b"".join(words) + end
                digests.append([zlib.crc32(raw[4 * r["s"] : 4 * (r["s"] + r["n"])]) for r in wanted])
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__text"), batch.column("__ranges"),
                 pa.array(digests, pa.list_(pa.int64()))],
                names=["__id", "__text", "__ranges", "__digests"],
            )

    return run


def packed(
    docs: DataFrame,
    window: int = WINDOW,
    slack: int = 64,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids_crc32`` is the CRC-32 of the piece's ids as little-endian unsigned
    32-bit numbers.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("__text"),
    )
    counted = write_out(
        texts.mapInArrow(_counted(tokenizer, window, end_id), _COUNTED), "pack-counts"
    )
    per_part = counted.where("__left > 0").groupBy("__part", "__left").agg(
        F.count(F.lit(1)).alias("__n")
    )
    # A row per partition and length that occurs in it.
    before = Window.partitionBy("__left").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    numbered = write_out(
        per_part.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))),
        "pack-numbers",
    )
    histogram = {
        row["__left"]: row["n"]
        for row in numbered.groupBy("__left").agg(F.sum("__n").alias("n")).collect()
    }
    combos = plan(histogram, window)
    table = spark.createDataFrame(places(combos, window, slack), _PLACES)

    # Bounded by the number of lengths, however many documents there are.
    lefts = (
        counted.where("__left > 0")
        .drop("__full")
        .join(numbered.drop("__n"), ["__part", "__left"])
        .withColumn("__number", F.col("__nth") + F.col("__before"))
        .join(F.broadcast(table), "__left")
        .where(F.col("__number").between(F.col("__first"), F.col("__last")))
        .withColumn("__base", F.col("doc_tokens") - F.col("__left"))
        .select(
            "doc_id",
            "__text",
            (F.col("__base") + F.col("__piece_start")).alias("start"),
            "length",
            F.when(F.col("length") == F.col("__left"), F.col("__left_crc")).alias("ids_crc32"),
            "doc_tokens",
            (
                F.col("__sequence") + (F.col("__number") - F.col("__first")) * F.col("__sequences")
            ).alias("sequence_id"),
            "offset",
        )
    )
    lefts = write_out(lefts, "pack-places")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = counted.where(F.size("__full") > 0).select(
        "doc_id", "doc_tokens", "__part", "__full_from", F.posexplode("__full")
    )
    sequence = F.shiftleft((F.col("__part") + 1).cast("bigint"), 40) + F.col("__full_from")
    whole = whole.select(
        "doc_id",
        (F.col("pos").cast("bigint") * window).alias("start"),
        F.lit(window).cast("bigint").alias("length"),
        F.col("col").alias("ids_crc32"),
        "doc_tokens",
        (sequence + F.col("pos")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    uncut = lefts.where(F.col("ids_crc32").isNotNull()).select(columns)
    return whole.unionByName(uncut).unionByName(
        _cut(texts, lefts.where(F.col("ids_crc32").isNull()), tokenizer, end_id).select(columns)
    )


def _cut(texts: DataFrame, pieces: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``pieces`` of cut leftovers with their digests; their texts are read again."""
    ranges = pieces.groupBy(F.col("doc_id").alias("__id"), "__text").agg(
        F.collect_set(F.struct(F.col("start").alias("s"), F.col("length").alias("n"))).alias(
            "__ranges"
        )
    )
    ranges = write_out(ranges.withColumnRenamed("__text", "__key"), "pack-cuts")
    same = texts["doc_id"].eqNullSafe(F.col("__id")) & (texts["__text"] == F.col("__key"))
    # Few documents are cut; joined by a shuffle, all texts would move for them.
    few = ranges.count() <= MOST_BROADCAST
    rows = texts.join(F.broadcast(ranges) if few else ranges, same).drop("doc_id", "__key")
    made = rows.select("__id", "__text", "text", "__ranges").mapInArrow(
        _digested(tokenizer, end_id),
        "__id bigint, __text bigint, __ranges array<struct<s:bigint,n:bigint>>, "
        "__digests array<bigint>",
    )
    each = made.select("__id", "__text", F.explode(F.arrays_zip("__ranges", "__digests")).alias("p"))
    each = each.select(
        "__id",
        F.col("__text").alias("__key"),
        F.col("p.__ranges.s").alias("__s"),
        F.col("p.__ranges.n").alias("__n"),
        F.col("p.__digests").alias("__crc"),
    ).dropDuplicates(["__id", "__key", "__s", "__n"])
    found = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.col("__text") == F.col("__key"))
        & (F.col("start") == F.col("__s"))
        & (F.col("length") == F.col("__n"))
    )
    return pieces.join(each, found).withColumn("ids_crc32", F.col("__crc"))
