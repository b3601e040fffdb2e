"""Collocations from a weighted de Bruijn graph of words.

Edges are the longest grams, of four words: each leads from its first three words, a
node, to its last three. An edge weighs as much as it occurs. Every word of a piece
starts one gram; near the end of a piece grams are shorter, and these are the
corrections for piece ends. The count of a shorter phrase is the flow that leaves its
node and what ends there: three words from the edges, two from the threes, one from the
twos. No shorter phrase is counted in the texts.

Grams too rare to be in any result are cut short before they move, as if a piece ended
there: no phrase of a result occurs in what is cut off. For that, hashes are counted in
two scans, first of words and pairs, then of grams of three and four words made of
frequent pairs; tasks send them block by block, five bytes each with its count. Sets of
``2 ** bits`` bits tell the frequent ones to all tasks. Rare grams that a set lets
through, by equal hashes or because it is small for the table, cost shuffled bytes and
change no count.

A node that all flow leaves by one edge, and where no piece ends, lies on a unary path.
It is folded into the longer phrase: it is kept for its count and not scored. Of the
rest, phrases are dropped whose words lie inside a longer one nearly as frequent.

Null texts are empty, null langs are ``und``. Texts and pieces of any length are read in
sections; a gram crosses them. Repeated rows count repeatedly. Equal scores go by count,
then by phrase. Columns besides text and lang are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from siltwork.llm.bitsets import BLOCK, blocks, collected, has
from siltwork.llm.subwords import small_slices
from siltwork.operators.skew import find_hot, spread_join
from siltwork.session import shuffle_partitions, write_out

LEAST = 30
LONGEST = 4
TOP = 2000
#: Share, in hundredths, of a phrase's occurrences inside one longer phrase that drops it.
INSIDE = 80
#: Bits of a set of frequent grams, as a power of two; 16 MB.
BITS = 27
SCALE = 2_000_000
SHARES = 64
_CUTS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_CUTS + b"\t", b"\n" * len(_CUTS) + b" ")
_SECTION = 4_000_000
_SLICE = 8_000_000
#: Hashes that a task counts before it sends them.
_HELD = 4_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORDS = [f"w{i + 1}" for i in range(LONGEST)]


class _Ids(dict):
    """Numbers of words from 1 on; 0 ends a piece, -1 is nothing."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})
        self.words: list[bytes | None] = [None]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


def _sections(text: bytes, size: int = _SECTION) -> Iterator[bytes]:
    """A text cut at blanks or line feeds, each section near ``size`` at most."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            at = max(text.rfind(b" ", start, end), text.rfind(b"\n", start, end))
            if at < 0:
                later = [i for i in (text.find(b" ", end), text.find(b"\n", end)) if i >= 0]
                at = min(later, default=len(text) - 1)
            end = at + 1
        yield text[start:end]
        start = end


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes | None]]:
    """Words of texts as numbers, a 0 after each piece, and the word of each number."""
    ids = _Ids()
    found = [np.zeros(1, dtype=np.int32)]
    for section in _sections(b"\n".join(texts).lower().translate(_PLAIN)):
        tokens = section.replace(b"\n", b" \n ").split(b" ")
        found.append(np.fromiter(map(ids.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
    flat = np.concatenate([*found, np.zeros(LONGEST, dtype=np.int32)])
    return flat[flat >= 0], ids.words


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list, np.ndarray]]:
    """Per slice and language: numbers of words, words, and hashes of the word at each place."""
    for batch in small_slices(batches, "text", _SLICE):
        by_lang: dict[str, list[bytes]] = {}
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            ids, words = numbered(texts)
            seed = xxh3_64_intdigest(lang.encode("utf-8", "replace"))
            hashes = np.array([0, *(xxh3_64_intdigest(w, seed) for w in words[1:])], dtype=np.uint64)
            yield lang, ids, words, hashes[ids]


def _grams(word: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the grams of ``size`` words from the given places on."""
    mixed = word[at]
    for i in range(1, size):
        mixed = (mixed * _FACTOR + word[at + i]) * _FACTOR
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _FACTOR
    return mixed ^ (mixed >> np.uint64(32)) ^ np.uint64(size)


def _starts(
    ids: np.ndarray, word: np.ndarray, known: dict[int, np.ndarray], bits: int, size: int
) -> np.ndarray:
    """Places where a gram of ``size`` words may be frequent, as far as shorter ones tell."""
    words = ids > 0
    if not known:
        if size == 1:
            return np.flatnonzero(words)
        return np.flatnonzero(words[:-1] & words[1:])
    at = np.flatnonzero(words[:-1] & words[1:])
    pair = np.zeros(len(ids), dtype=bool)
    pair[at] = _frequent(_grams(word, at, 2), known[2], bits)
    inside = pair[: len(pair) - size + 2].copy()
    for i in range(1, size - 1):
        inside &= pair[i : len(pair) - size + 2 + i]
    return np.flatnonzero(inside)


def _frequent(hashes: np.ndarray, found: np.ndarray, bits: int) -> np.ndarray:
    return has(found, (hashes >> np.uint64(64 - bits)).astype(np.int64))


def _frequent_grams(
    docs: DataFrame, sizes: tuple[int, ...], known: dict, least: int, bits: int
) -> np.ndarray:
    """The set of hashes of grams of these sizes that occur ``least`` times in a language."""
    spark = docs.sparkSession
    shared = {n: spark.sparkContext.broadcast(found.tobytes()) for n, found in known.items()}
    edge = np.arange(blocks(bits) + 1).astype(np.uint64) << np.uint64(64 - bits + BLOCK)

    def sent(hashes: np.ndarray) -> pa.RecordBatch:
        found, times = np.unique(hashes, return_counts=True)
        cuts = np.append(np.searchsorted(found, edge[:-1]), len(found))
        rest = (found << np.uint64(bits - BLOCK)) >> np.uint64(32)
        times = np.minimum(times, least).astype("<u2")
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        spans = [(cuts[i], cuts[i + 1]) for i in some]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array([rest[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                pa.array([times[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "rest", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {n: np.frombuffer(s.value, dtype=np.uint8) for n, s in shared.items()}
        held, size = [], 0
        for _, ids, _, word in _groups(batches):
            for n in sizes:
                held.append(_grams(word, _starts(ids, word, sets, bits, n), n))
                size += len(held[-1])
            if size >= _HELD:
                yield sent(np.concatenate(held))
                held, size = [], 0
        if size:
            yield sent(np.concatenate(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for block, rest, times in zip(*(column.to_pylist() for column in batch.columns)):
                found.setdefault(block, []).append((rest, times))
        for block, parts in found.items():
            rest = np.frombuffer(b"".join(r for r, _ in parts), dtype="<u4")
            times = np.frombuffer(b"".join(t for _, t in parts), dtype="<u2").astype(np.int64)
            order = np.argsort(rest)
            rest, times = rest[order], times[order]
            starts = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
            often = rest[starts[np.add.reduceat(times, starts) >= least]]
            if len(often):
                marked = np.zeros(1 << BLOCK, dtype=bool)
                marked[often >> np.uint32(32 - BLOCK)] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int32()),
                        pa.array([np.packbits(marked).tobytes()], pa.binary()),
                    ],
                    names=["block", "bits"],
                )

    counted = docs.mapInArrow(run, "block int, rest binary, times binary")
    parts = min(shuffle_partitions(spark), blocks(bits))
    merged = counted.repartition(parts, "block").mapInArrow(merge, "block int, bits binary")
    return collected(merged, bits)


def edges(docs: DataFrame, least: int = LEAST, bits: int = BITS) -> DataFrame:
    """Rows (lang, w1 .. w4, c): grams that words start, shorter where a longer one is rare
    or a piece ends; words that are rare themselves are one row without words.

    Written; equal grams of one slice of texts are one row.
    """
    context = docs.sparkSession.sparkContext
    short = _frequent_grams(docs, (1, 2), {}, least, bits)
    known = {1: short, 2: short}
    long = _frequent_grams(docs, (3, 4), known, least, bits)
    shared = [context.broadcast(found.tobytes()) for found in (short, short, long, long)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {n + 1: np.frombuffer(s.value, dtype=np.uint8) for n, s in enumerate(shared)}
        for lang, ids, words, word in _groups(batches):
            at = np.flatnonzero(ids > 0)
            reached = np.zeros(len(ids), dtype=np.int8)
            for size in range(1, LONGEST + 1):
                if size > 1:
                    at = at[ids[at + size - 1] > 0]
                at = at[_frequent(_grams(word, at, size), sets[size], bits)]
                reached[at] = size
            rare = int(np.count_nonzero((ids > 0) & (reached == 0)))
            at = np.flatnonzero(reached)
            grams = np.zeros((LONGEST, len(at)), dtype=np.int64)
            for i in range(LONGEST):
                inside = reached[at] > i
                grams[i, inside] = ids[at[inside] + i]
            # Two numbers make a pair's key, two keys, numbered densely, a gram's.
            first, a = np.unique(grams[0] << 32 | grams[1], return_inverse=True)
            last, b = np.unique(grams[2] << 32 | grams[3], return_inverse=True)
            found, times = np.unique(a * max(len(last), 1) + b, return_counts=True)
            a, b = first[found // max(len(last), 1)], last[found % max(len(last), 1)]
            low = (1 << 32) - 1
            columns = [np.append(c, 0) for c in (a >> 32, a & low, b >> 32, b & low)]
            spelled = pa.array(words, pa.binary()).cast(pa.string())
            counts = np.append(times, rare).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts), pa.string()),
                    *(spelled.take(pa.array(c)) for c in columns),
                    pa.array(counts),
                ],
                names=["lang", *_WORDS, "c"],
            )

    schema = "lang string, " + ", ".join(f"{w} string" for w in _WORDS) + ", c bigint"
    return write_out(docs.mapInArrow(run, schema), "phrase-edges")


def _flow(grams: DataFrame, size: int) -> DataFrame:
    """Counts of the first ``size`` words, and whether one edge takes all that leaves them."""
    following = f"w{size + 1}"
    return grams.groupBy("lang", *_WORDS[:size]).agg(
        F.sum("c").alias("c"),
        ((F.count(F.lit(1)) == 1) & (F.count(following) == 1)).alias("folded"),
    )


def _named(counted: DataFrame, size: int, least: int) -> DataFrame:
    return counted.where((F.col("c") >= least) & F.col("w1").isNotNull()).select(
        "lang",
        F.concat_ws(" ", *_WORDS[:size]).alias("phrase"),
        F.lit(size).alias("size"),
        F.col("c").alias("a"),
        "folded",
    )


def counted(grams: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases found ``least`` times, and of all words per language.

    Rows (lang, phrase, size, a, folded) and (lang, n).
    """
    whole = grams.where("w2 is not null").groupBy("lang", *_WORDS).agg(F.sum("c").alias("c"))
    flows = {LONGEST: write_out(whole, "phrase-flow")}
    for size in range(LONGEST - 1, 0, -1):
        longer = flows[size + 1]
        if size + 1 < LONGEST:
            # What ends after that many words comes beside the flow of longer grams.
            ends = flows[LONGEST] if size > 1 else grams
            ends = ends.where(f"w{size + 1} is null" + (f" and w{size} is not null" if size > 1 else ""))
            columns = ["lang", *_WORDS[: size + 1], "c"]
            longer = longer.select(*columns).unionByName(ends.select(*columns))
        else:
            longer = longer.where(f"w{size} is not null")
        flows[size] = write_out(_flow(longer, size), "phrase-flow")
    words = flows[1].groupBy("lang").agg(F.sum("c").alias("n"))
    full = flows[LONGEST].where(f"w{LONGEST} is not null").withColumn("folded", F.lit(False))
    phrases = _named(full, LONGEST, least)
    for size in range(1, LONGEST):
        phrases = phrases.unionByName(_named(flows[size], size, least))
    return write_out(phrases, "phrases"), words


def _inner(phrase: Column, size: Column) -> Column:
    """Shorter phrases of two words or more inside a phrase."""
    words = F.split(phrase, " ")
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), size - n + 1),
                lambda i: F.array_join(F.slice(words, i, n), " "),
            ),
        )
    )
    return F.array_distinct(places)


def _looked_up(rows: DataFrame, phrases: DataFrame, part: str, name: str) -> DataFrame:
    key = ("lang", part)
    facts = phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    return spread_join(rows, facts, key, "left", find_hot(rows, key))


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE, bits: int = BITS
) -> DataFrame:
    """The ``top`` phrases of each language by the score of their worst cut.

    Rows (lang, rank, phrase, k, a, l, r, n, score): cut after ``k`` words.
    """
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    phrases, words = counted(edges(texts, least, bits), least)
    longer = (
        phrases.where("size > 2")
        .select("lang", F.explode(_inner(F.col("phrase"), F.col("size"))).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    whole = F.coalesce("longer", F.lit(0)) * 100 < F.col("a") * inside
    candidates = phrases.where("size > 1 and not folded").join(longer, ["lang", "phrase"], "left")
    cuts = candidates.where(whole).select(
        "lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = write_out(
        cuts.withColumns(
            {
                "before": F.expr("substring_index(phrase, ' ', k)"),
                "after": F.expr("substring_index(phrase, ' ', k - size)"),
            }
        ),
        "phrase-cuts",
    )
    cuts = _looked_up(cuts, phrases, "before", "l")
    cuts = _looked_up(cuts, phrases, "after", "r")
    # Wide decimals, as counts times the scale may pass 64 bits.
    score = F.expr(f"cast(a as decimal(20,0)) * {SCALE} div cast(l + r as decimal(20,0))")
    worst = (
        cuts.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.*")
    )
    # The best of each share of a language first, so that no task sorts a whole language.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    shares = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(SHARES))).orderBy(*best)
    some = worst.withColumn("rank", F.row_number().over(shares)).where(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*best)
    ranked = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang", "left").select(
        "lang", F.col("rank").cast("bigint"), "phrase", F.col("k").cast("bigint"), "a", "l", "r", "n", "score"
    )

