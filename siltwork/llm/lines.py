"""Lines that many documents share, found with two Bloom filters.

A first scan marks the hash of every long enough line in one of two filters: seen
once, or seen by a second document too. Tasks send the marked places of a filter
block by block, two bytes each, so what moves is small and neither a block nor the
filter grows with the table. The second filter, of ``2 ** bits`` bits, goes to all
tasks; a second scan asks it about each line, and only lines that may repeat are
shuffled, as digests: they are counted exactly, the largest id that holds one is
chosen, and every other document loses it. A set of bits of the same size then tells
the documents that hold a line repeated often enough; only their texts move, to meet
the digests they lose. Filters too small for a table only let more lines and texts
through to the exact steps; the result is the same.

Null and empty texts are one empty line. Each row is a document, also one whose id
or text repeats; null ids count as smaller than all others, so rows without an id
lose a line that a row with an id holds, and keep it if none does. A line found
twice in one document counts once there, and both go. Very long texts are handled
one at a time. Input columns besides the id and the text are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from siltwork.llm.bitsets import BLOCK, blocks, collected, has
from siltwork.llm.heavy import joined
from siltwork.llm.subwords import small_slices
from siltwork.session import shuffle_partitions, write_out

#: Bits of a filter, as a power of two; 32 MB.
BITS = 28
_PLACES = 2
LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
_BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int = LEAST_CHARS) -> bytes | None:
    """The line without blanks around it and with A-Z lower-cased; None if it is short."""
    key = line.strip(_BLANKS).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return key


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def _keys(text: bytes, least: int) -> set[bytes]:
    """Distinct keys of a text's long lines."""
    if len(text) < least:
        return set()
    found = {line_key(line, least) for line in text.split(b"\n")}
    found.discard(None)
    return found


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Rows of ``_PLACES`` bit numbers in the filter, all in one block, per 64-bit hash."""
    block = (hashes >> np.uint64(64 - bits + BLOCK)) << np.uint64(BLOCK)
    within = [(hashes >> np.uint64(BLOCK * i)) & np.uint64((1 << BLOCK) - 1) for i in range(_PLACES)]
    return np.stack([block | w for w in within], axis=1).astype(np.int64)


def _marks(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """Rows (block, once, twice): places that lines of some documents mark, as uint16."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 16_000_000):
            hashes = [xxh3_64_intdigest(k) for text in _texts(batch) for k in _keys(text, least)]
            if not hashes:
                continue
            marked = places(np.array(hashes, dtype=np.uint64), bits)
            # Equal places of one line mark its bit once.
            same = marked[:, 0] == marked[:, 1]
            flat = np.concatenate([marked[:, 0], marked[~same, 1]])
            found, times = np.unique(flat, return_counts=True)
            again = found[times > 1]
            at, starts = np.unique(found >> BLOCK, return_index=True)
            ends = np.append(starts[1:], len(found))
            firsts = np.searchsorted(again, at << BLOCK)
            lasts = np.searchsorted(again, (at + 1) << BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at.astype(np.int32)),
                    pa.array([found[a:b].astype("<u2").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([again[a:b].astype("<u2").tobytes() for a, b in zip(firsts, lasts)], pa.binary()),
                ],
                names=["block", "once", "twice"],
            )

    return docs.select("text").mapInArrow(run, "block int, once binary, twice binary")


def repeat_filter(docs: DataFrame, bits: int = BITS, least: int = LEAST_CHARS) -> np.ndarray:
    """Bytes of the filter of lines seen twice; at most ``2 ** (bits - 3)`` reach the driver."""
    parts = min(shuffle_partitions(docs.sparkSession), blocks(bits))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, seen, again in zip(*(column.to_pylist() for column in batch.columns)):
                if block not in once:
                    once[block] = np.zeros(1 << BLOCK, dtype=bool)
                    twice[block] = np.zeros(1 << BLOCK, dtype=bool)
                at = np.frombuffer(seen, dtype="<u2")
                twice[block][at[once[block][at]]] = True
                twice[block][np.frombuffer(again, dtype="<u2")] = True
                once[block][at] = True
        kept = [block for block in twice if twice[block].any()]
        if kept:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.int32()),
                    pa.array([np.packbits(twice[b]).tobytes() for b in kept], pa.binary()),
                ],
                names=["block", "bits"],
            )

    marked = _marks(docs, bits, least).repartition(parts, "block")
    return collected(marked.mapInArrow(merge, "block int, bits binary"), bits)


def _asked(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """Rows of documents with their number of lines, digests of lines that may repeat, and,
    where there are such lines, the text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeat_filter(docs, bits, least).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(shared.value, dtype=np.uint8)
        number = TaskContext.get().partitionId() << 40
        for batch in small_slices(batches, "text", 16_000_000):
            texts = _texts(batch)
            keys = [list(_keys(text, least)) for text in texts]
            hashes = np.array([xxh3_64_intdigest(k) for found in keys for k in found], dtype=np.uint64)
            at = places(hashes, bits)
            hit = has(seen, at).all(axis=1).tolist()
            suspects, start = [], 0
            for found in keys:
                hits = hit[start : start + len(found)]
                start += len(found)
                suspects.append([_digest(k) for k, h in zip(found, hits) if h])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + batch.num_rows), pa.int64()),
                    batch.column("doc_id"),
                    pa.array([text.count(b"\n") + 1 for text in texts], pa.int64()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string()),
                    pa.array(suspects, pa.list_(pa.binary())),
                    pa.array([t if s else None for t, s in zip(texts, suspects)], pa.binary()),
                ],
                names=["uid", "doc_id", "n_lines", "whole_sha256", "suspects", "body"],
            )
            number += batch.num_rows

    schema = (
        "uid bigint, doc_id bigint, n_lines bigint, whole_sha256 string, "
        "suspects array<binary>, body binary"
    )
    return write_out(docs.select("doc_id", "text").mapInArrow(run, schema), "lines-asked")


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _kept(rows: DataFrame, least: int) -> DataFrame:
    """Documents without the lines whose digests are in ``drops``, which may be NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "body", 16_000_000):
            counts, texts, digests = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("body", "drops", "whole_sha256"))
            for body, drops, whole in zip(*columns):
                if not drops:
                    counts.append(0)
                    texts.append(None)
                    digests.append(whole)
                    continue
                gone, lines = set(drops), body.split(b"\n")
                kept = [x for x in lines if (k := line_key(x, least)) is None or _digest(k) not in gone]
                counts.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept))
                digests.append(hashlib.sha256(texts[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_lines"),
                    pa.array(counts, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_text", "kept_sha256"],
            )

    return rows.mapInArrow(
        run,
        "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string, kept_sha256 string",
    )


def _digest_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little")


def _confirmed(repeated: DataFrame, bits: int) -> np.ndarray:
    """The set of digests that are repeated often enough."""
    parts = min(shuffle_partitions(repeated.sparkSession), blocks(bits))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_digest_hash(d) for d in batch.column("digest").to_pylist()]
            at = places(np.array(hashes, dtype=np.uint64), bits)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> BLOCK).astype(np.int32)), pa.array(at)], names=["block", "at"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at in zip(*(column.to_pylist() for column in batch.columns)):
                if block not in marked:
                    marked[block] = np.zeros(1 << BLOCK, dtype=bool)
                marked[block][at & ((1 << BLOCK) - 1)] = True
        if marked:
            packed = [np.packbits(found).tobytes() for found in marked.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(marked), pa.int32()), pa.array(packed, pa.binary())],
                names=["block", "bits"],
            )

    placed = repeated.select("digest").mapInArrow(place, "block int, at bigint")
    placed = placed.distinct().repartition(parts, "block")
    return collected(placed.mapInArrow(merge, "block int, bits binary"), bits)


def _may_lose(repeated: DataFrame, bits: int) -> Column:
    """Whether some of a document's suspected lines is repeated often enough."""
    shared = repeated.sparkSession.sparkContext.broadcast(_confirmed(repeated, bits).tobytes())

    @F.arrow_udf("boolean")
    def some(suspects: pa.Array) -> pa.Array:
        known = np.frombuffer(shared.value, dtype=np.uint8)
        digests = suspects.to_pylist()
        hashes = np.array([_digest_hash(d) for s in digests for d in s], dtype=np.uint64)
        hit = has(known, places(hashes, bits)[:, 0])
        ends = np.cumsum([0, *(len(s) for s in digests)])
        return pa.array([bool(hit[a:b].any()) for a, b in zip(ends, ends[1:])], pa.bool_())

    return some("suspects")


def _repeated(lines: DataFrame, least_documents: int) -> DataFrame:
    """Digests that so many documents hold, their number and the largest id of one."""
    counted = lines.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")
    )
    return write_out(counted.where(F.col("n") >= least_documents), "lines-repeated")


def _drops(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows (uid, drops): digests of the lines that each document loses."""
    lost = joined(lines, repeated, "digest", "n").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # As many digests as one document has lines.
    return lost.groupBy("uid").agg(F.collect_list("digest").alias("drops"))


def deduplicated(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    bits: int = BITS,
) -> DataFrame:
    """Rows (doc_id, n_lines, n_dropped, kept_text, kept_sha256) of all ``docs``.

    ``kept_text`` is NULL where nothing is dropped: the text is as it was.
    """
    asked = _asked(docs, bits, least_chars)
    lines = asked.select("uid", "doc_id", F.explode("suspects").alias("digest"))
    repeated = _repeated(lines, least_documents)
    loses = _may_lose(repeated, bits)
    # Always by a shuffle: drops grow with the table as the texts do.
    drops = _drops(lines, repeated).hint("merge")
    losing = asked.where(loses).drop("suspects").join(drops, "uid", "left")
    untouched = asked.where(~loses).select(
        "doc_id",
        "n_lines",
        F.lit(0).cast("bigint").alias("n_dropped"),
        F.lit(None).cast("string").alias("kept_text"),
        F.col("whole_sha256").alias("kept_sha256"),
    )
    return _kept(losing, least_chars).unionByName(untouched)
