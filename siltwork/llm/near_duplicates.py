"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of its word shingles. Sets that are equal form a class and
only one of each takes part. A class keeps the ``k`` smallest hashes of its set.
If two sets have a similarity of at least ``t``, so many of the kept values are
shared that missing it has a chance below ``MISS`` (``least_shared``). Sorted
with the rarest first, two such sketches then share one of the first
``k - least_shared + 1`` values, so only those are listed: what very many
documents have in common is hardly listed at all, without any cap. A set of up to
``k`` values lists fewer, as it surely shares most of them (``listed_of_whole``).

A list is not turned into pairs. First all its members are compared with its
head, the one with the fewest values of its own; that links large groups to the
text they were made from. Where members of a head then still belong to several
components, those outside the head's are compared with the others in blocks:
numpy multiplies incidence matrices of sketches, then of the full sets of those
that are likely, and only links come out. The sketch of the union estimates a
pair's similarity; all links are confirmed on the full sets.

Null and empty texts have no shingles and are linked with nothing. A text with
fewer words than a shingle is one shingle. Rows with equal texts share a group;
of repeated ids the first row stays. Null ids count as larger than all others.
Columns of the input may have any names not starting with ``__``. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_hexdigest

from siltwork.llm.components import components
from siltwork.llm.subwords import small_slices
from siltwork.session import write_out

K = 64
MISS = 1e-7
#: Ids of candidates up to this number are broadcast, 16 bytes each at most.
MOST_BROADCAST = 1_000_000
_KEPT_HASHES = 2_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``size`` words, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        mixed = _scrambled(mixed * _FACTOR + hashes[i : i + len(mixed)])
    return np.unique(mixed)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit mixing generator (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def least_shared(k: int, threshold: float) -> int:
    """Most values that two sets of that similarity share but with a chance below ``MISS``."""
    chance, s = 0.0, 0
    while s < k:
        chance += math.comb(k, s) * threshold**s * (1 - threshold) ** (k - s)
        if chance > MISS:
            return max(s, 1)
        s += 1
    return k


def listed_of_whole(n: int, k: int, threshold: float) -> int:
    """How many values a set of ``n <= k`` lists, all of which its sketch has.

    Of a similar set with ``m > k`` values, ``m - k`` are not in its sketch, so of
    those shared as many may be missing there; most for the largest ``m``.
    """
    t = round(threshold * 100)
    few = (100 - t) * n // 100 + 1
    m = 100 * n // t
    if m <= k:
        return few
    shared = -(-t * (n + m) // (100 + t)) - (m - k)
    return max(few, n - max(shared, least_shared(k, threshold)) + 1)


def tagged(docs: DataFrame, size: int, k: int) -> DataFrame:
    """``docs`` written with a row number, set size, digest and sketch of each text."""
    schema = T.StructType(list(docs.schema.fields)).add("__uid", "long").add("__n", "long")
    schema = schema.add("__digest", "string").add("__sketch", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in small_slices(batches, "text"):
            counts, digests, sketches = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), size)
                counts.append(len(found))
                digests.append(xxh3_128_hexdigest(found.tobytes()))
                sketches.append(found[:k].view(np.int64))
            uids = np.arange(number, number + batch.num_rows)
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(uids, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=[*batch.schema.names, "__uid", "__n", "__digest", "__sketch"],
            )

    return write_out(docs.mapInArrow(run, schema), "near-tagged")


def _similar_sizes(a: Column, b: Column, threshold: float) -> Column:
    """Sizes whose sets can be that similar; in whole hundredths, so exact."""
    t = round(threshold * 100)
    return (100 * F.least(a, b)) >= (t * F.greatest(a, b))


def _listed(nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """Rows (v, node, n, own): the rarest values of each sketch that others have, too.

    ``own`` is how many values of the sketch no other has.
    """
    values = nodes.select("node", F.explode("sketch").alias("v"))
    shared = write_out(
        values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-shared"
    )
    kept = nodes.select("node", "n", F.size("sketch").alias("size"))
    found = (
        values.join(shared, "v")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("by"))
        .join(kept, "node")
    )
    whole = F.array(*[F.lit(listed_of_whole(n, k, threshold)) for n in range(1, k + 1)])
    first = F.when(F.col("n") <= k, F.get(whole, F.col("n").cast("int") - 1)).otherwise(
        k - least_shared(k, threshold) + 1
    )
    # Values that no other set has are the rarest of all.
    own = F.col("size") - F.size("by")
    rest = (first - own).cast("int")
    return write_out(
        found.where(rest > 0)
        .select("node", "n", own.alias("own"), F.explode(F.slice("by", F.lit(1), rest)).alias("x"))
        .select(F.col("x.v").alias("v"), "node", "n", "own"),
        "near-lists",
    )


def _likely(pairs: DataFrame, nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs that the sketch of the union does not rule out, with whether it settles them."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    rows = pairs.join(a, "a").join(b, "b")
    shared = F.array_intersect("sa", "sb")
    # Sketches are in the order of unsigned hashes; flipping the sign bit gives it.
    flip = F.lit(-(2**63))
    union = F.slice(
        F.array_sort(F.transform(F.array_union("sa", "sb"), lambda v: v.bitwiseXOR(flip))), 1, k
    )
    last = F.array_max(union)
    hits = F.size(F.filter(shared, lambda v: v.bitwiseXOR(flip) <= last))
    whole = (F.col("na") <= k) & (F.col("nb") <= k)
    t = round(threshold * 100)
    exact = 100 * F.size(shared) >= t * F.size(F.array_union("sa", "sb"))
    likely = F.when(whole, exact).otherwise(
        hits >= F.least(F.lit(least_shared(k, threshold)), F.size(union))
    )
    return rows.where(likely).select("a", "b", whole.alias("settled"))


def _confirmed(
    pairs: DataFrame, documents: DataFrame, size: int, threshold: float
) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    pairs = write_out(pairs, "near-pairs")
    open_pairs = pairs.where("not settled").select("a", "b")
    wanted = write_out(
        open_pairs.select(F.explode(F.array("a", "b")).alias("__uid")).distinct(), "near-wanted"
    )
    few = wanted.count() <= MOST_BROADCAST
    texts = documents.select("__uid", "text").join(
        F.broadcast(wanted) if few else wanted, "__uid", "left_semi"
    )
    left = texts.select(F.col("__uid").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("__uid").alias("b"), F.col("text").alias("tb"))
    t = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, np.ndarray] = OrderedDict()
        held = 0

        def of(uid: int, text) -> np.ndarray:
            nonlocal held
            if uid in kept:
                kept.move_to_end(uid)
            else:
                kept[uid] = shingles(text.as_py(), size)
                held += len(kept[uid])
                while held > _KEPT_HASHES and len(kept) > 1:
                    held -= len(kept.popitem(last=False)[1])
            return kept[uid]

        for batch in small_slices(batches, "ta"):
            a, b = batch.column("a"), batch.column("b")
            texts_a, texts_b = batch.column("ta"), batch.column("tb")
            similar = []
            for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                first, second = of(x, texts_a[i]), of(y, texts_b[i])
                both = len(np.intersect1d(first, second, assume_unique=True))
                similar.append(100 * both >= t * (len(first) + len(second) - both))
            keep = pa.array(similar, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    joined = open_pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    sure = pairs.where("settled").select("a", "b")
    return write_out(joined.mapInArrow(run, "a bigint, b bigint").unionByName(sure), "near-links")


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _blocks(members: DataFrame, main: DataFrame, block: int) -> DataFrame:
    """Rows of ``members`` (a, node, component) in blocks (a, i, j) of strays and others.

    Strays are the members outside the component of their head ``a``, in
    ``main``. Each block of strays meets each block of members, in a row of its
    own, so a block's size does not depend on how many members a head has.
    """
    rows = members.join(main, "a").withColumn("stray", F.col("component") != F.col("main"))
    sizes = rows.groupBy("a").agg(
        F.ceil(F.count_if("stray") / block).alias("ni"),
        F.ceil(F.count(F.lit(1)) / block).alias("nj"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    sizes = write_out(sizes.where("low <> high and ni > 0").select("a", "ni", "nj"), "near-sizes")
    rows = rows.join(sizes, "a")
    zero = F.lit(0).cast("bigint")
    number = F.xxhash64("node")
    kept = [c for c in members.columns if c != "a"]
    strays = rows.where("stray").select(
        "a",
        F.pmod(number, F.col("ni")).alias("i"),
        F.explode(F.sequence(zero, F.col("nj") - 1)).alias("j"),
        F.lit(True).alias("first"),
        "stray",
        *kept,
    )
    others = rows.select(
        "a",
        F.explode(F.sequence(zero, F.col("ni") - 1)).alias("i"),
        F.pmod(number, F.col("nj")).alias("j"),
        F.lit(False).alias("first"),
        "stray",
        *kept,
    )
    return strays.unionByName(others)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows with the same (a, i, j); such rows follow each other."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("a", "i", "j")], axis=1)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[start].tolist())
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _overlaps(values: pa.Array, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of ``first`` rows with those of the others."""
    flat = values.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.cumsum(first) - 1
    other_place = np.cumsum(~first) - 1
    found = np.zeros((int(first.sum()), int((~first).sum())), dtype=np.float32)
    distinct, column = np.unique(flat, return_inverse=True)
    left = first[row]
    both = (np.bincount(column[left], minlength=len(distinct)) > 0) & (
        np.bincount(column[~left], minlength=len(distinct)) > 0
    )
    number = np.cumsum(both) - 1
    keep = both[column]
    row, column, left = row[keep], number[column[keep]], left[keep]
    for start in range(0, int(both.sum()), 4096):
        here = (column >= start) & (column < start + 4096)
        width = min(4096, int(both.sum()) - start)
        x = np.zeros((found.shape[0], width), dtype=np.float32)
        y = np.zeros((found.shape[1], width), dtype=np.float32)
        x[place[row[here & left]], column[here & left] - start] = 1
        y[other_place[row[here & ~left]], column[here & ~left] - start] = 1
        found += x @ y.T
    return found


def _compared(block: pa.Table, column: str):
    """Of a block: strays and others as (node, n, component), overlaps, and pairs to look at."""
    first = block.column("first").to_numpy()
    sets = block.column(column).combine_chunks()
    lengths = np.diff(sets.offsets.to_numpy())
    overlaps = _overlaps(sets.flatten(), lengths, first)
    x, y = (
        {c: block.column(c).to_numpy()[side] for c in ("node", "n", "component", "stray")}
        for side in (first, ~first)
    )
    wanted = x["component"][:, None] != y["component"][None, :]
    # Two strays meet twice; once is enough.
    wanted &= ~y["stray"][None, :] | (x["node"][:, None] < y["node"][None, :])
    return x, y, overlaps, wanted


def _first_links(x, y, linked: np.ndarray) -> tuple[list[int], list[int]]:
    """A link of each stray to each component, of those in the matrix ``linked``."""
    rows, columns = np.nonzero(linked)
    pairs = np.stack([x["node"][rows], y["component"][columns]], axis=1)
    _, kept = np.unique(pairs, axis=0, return_index=True)
    return x["node"][rows[kept]].tolist(), y["node"][columns[kept]].tolist()


def _among_members(
    members: DataFrame,
    found: DataFrame,
    nodes: DataFrame,
    documents: DataFrame,
    size: int,
    threshold: float,
    k: int,
) -> DataFrame:
    """Links between members of a head that lie in different components."""
    t = round(threshold * 100)
    least = least_shared(k, threshold)
    placed = _with_component(members.select("a", "node", "n"), found)
    main = members.select(F.col("a").alias("node")).distinct()
    main = _with_component(main, found).select(
        F.col("node").alias("a"), F.col("component").alias("main")
    )
    main = write_out(main, "near-main")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            x, y, overlaps, wanted = _compared(block, "sketch")
            a, b = x["n"][:, None], y["n"][None, :]
            wanted &= 100 * np.minimum(a, b) >= t * np.maximum(a, b)
            whole = (a <= k) & (b <= k)
            one, other = _first_links(x, y, wanted & whole & (100 * overlaps >= t * (a + b - overlaps)))
            possible = wanted & ~whole & (overlaps >= least)
            open_nodes = [
                *x["node"][possible.any(axis=1)].tolist(),
                *y["node"][possible.any(axis=0)].tolist(),
            ]
            head = block.column("a")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([True] * len(one) + [False] * len(open_nodes), pa.bool_()),
                    pa.array(one + [head] * len(open_nodes), pa.int64()),
                    pa.array(other + open_nodes, pa.int64()),
                ],
                names=["link", "a", "b"],
            )

    sketches = nodes.select("node", "sketch")
    rows = _blocks(placed, main, 1024).join(sketches, "node")
    key = ("a", "i", "j")
    rows = rows.repartition(*key).sortWithinPartitions(*key)
    first = write_out(rows.mapInArrow(likely, "link boolean, a bigint, b bigint").distinct(), "near-likely")
    sure = first.where("link").select("a", "b")

    # The full sets of those that a sketch cannot rule out.
    active = first.where("not link").select("a", F.col("b").alias("node")).distinct()
    active = write_out(active.join(placed, ["a", "node"]), "near-active")
    wanted = write_out(active.select(F.col("node").alias("__uid")).distinct(), "near-wanted")
    few = wanted.count() <= MOST_BROADCAST
    texts = documents.select("__uid", "text").join(
        F.broadcast(wanted) if few else wanted, "__uid", "left_semi"
    )

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            sets = [shingles(text.as_py(), size).view(np.int64) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__uid"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"]
            )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            x, y, overlaps, wanted = _compared(block, "set")
            union = x["n"][:, None] + y["n"][None, :] - overlaps
            one, other = _first_links(x, y, wanted & (100 * overlaps >= t * union))
            yield pa.RecordBatch.from_arrays(
                [pa.array(one, pa.int64()), pa.array(other, pa.int64())], names=["a", "b"]
            )

    sets = texts.mapInArrow(as_sets, "node bigint, set array<bigint>")
    rows = _blocks(active, main, 512).join(sets, "node")
    rows = rows.repartition(*key).sortWithinPartitions(*key)
    more = rows.mapInArrow(linked, "a bigint, b bigint").distinct()
    return write_out(more.unionByName(sure), "near-links")


def grouped(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, k: int = K
) -> DataFrame:
    """``docs`` with ``__n`` (set size), ``__component`` (smallest id) and ``__first``.

    ``__first`` marks one row of each group: that of the smallest id.
    """
    documents = tagged(docs, size, k)
    classes = write_out(
        documents.where("__n > 0").groupBy("__digest").agg(F.min("__uid").alias("node")),
        "near-classes",
    )
    nodes = write_out(
        documents.select(
            F.col("__uid").alias("node"), F.col("__n").alias("n"), F.col("__sketch").alias("sketch")
        ).join(classes.select("node"), "node"),
        "near-nodes",
    )
    lists = _listed(nodes, k, threshold)

    # Every member of a list against its head.
    heads = write_out(
        lists.groupBy("v")
        .agg(F.min(F.struct("own", "node", "n")).alias("head"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select(
            "v",
            F.col("head.node").alias("a"),
            F.col("head.n").alias("na"),
            (F.col("members") > 2).alias("others"),
        ),
        "near-heads",
    )
    # Who is alone with a head has no other member to be compared with.
    members = write_out(
        lists.join(heads, "v")
        .where(F.col("a") != F.col("node"))
        .where(_similar_sizes(F.col("na"), F.col("n"), threshold) | F.col("others"))
        .groupBy("a", "na", "node", "n")
        .agg(F.max("others").alias("others")),
        "near-members",
    )
    stars = members.where(_similar_sizes(F.col("na"), F.col("n"), threshold))
    stars = stars.select("a", F.col("node").alias("b"))
    links = _confirmed(_likely(stars, nodes, k, threshold), documents, size, threshold)
    found = write_out(components(links), "near-components")
    members = members.where("others").select("a", "node", "n")
    more = _among_members(members, found, nodes, documents, size, threshold, k)
    found = write_out(components(links.unionByName(more)), "near-components")

    # From classes back to rows.
    rows = documents.select("__uid", "__digest", F.col("doc_id").alias("__id"))
    rows = rows.join(classes, "__digest", "left").withColumn("node", F.coalesce("node", "__uid"))
    rows = write_out(_with_component(rows, found), "near-rows")
    first = rows.groupBy("component").agg(
        F.min("__id").alias("__component"),
        F.min(F.struct(F.col("__id").isNull(), "__id", "__uid")).alias("first"),
    )
    first = write_out(
        first.select("component", "__component", F.col("first.__uid").alias("first")), "near-first"
    )
    decided = rows.join(first, "component").select(
        "__uid", "__component", (F.col("__uid") == F.col("first")).alias("__first")
    )
    return documents.drop("__digest", "__sketch").join(decided, "__uid")


def deduplicated(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, k: int = K
) -> DataFrame:
    """One row of ``docs`` of each group."""
    return grouped(docs, size, threshold, k).where("__first").select(*docs.columns)
