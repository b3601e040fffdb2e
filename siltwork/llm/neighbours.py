"""Nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are centred, scaled into the unit ball and given one more coordinate that
puts them on the sphere, so that the largest inner product is the smallest
distance. Each of ``TABLES`` tables projects on ``AXES`` Gaussian directions cut
into buckets of width ``WIDTH``; a cell is one bucket on each axis. For a query
the chance that its neighbours lie in a cell follows from their distance, which the
query's own nearest vectors of a sample tell. Cells are visited in the order of that
chance until they hold a neighbour with chance ``SUCCESS`` in each table; the chance at
which to stop comes from drawing neighbours at random. Candidates of all tables are
merged and ranked by the inner product of the original vectors. A query whose last
neighbour found is farther than was assumed goes on probing with the distance found,
and one with too few visits all cells, so none has fewer neighbours than there are.

Cells that agree on the first ``ROUTED`` axes are searched by one task, or by
several where there are many vectors or queries, and a query is sent only to
where it may visit a cell. Equal vectors are indexed once, with as many of their
smallest ids as a result can hold.

Null and zero vectors, and those with null or non-finite components or another
length than most, take no part. Repeated rows count once; rows that repeat an id
with another vector are candidates of their own. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.samples import share_of
from siltwork.session import write_out

TABLES, AXES, ROUTED = 2, 12, 3
WIDTH = 2.5
SUCCESS = 0.9
#: Vectors and queries searched at once, vectors of the sample.
VECTORS, QUERIES = 8192, 2048
SAMPLE = 4000
#: A last neighbour so many times farther than assumed makes a query go on probing.
FARTHER = 1.0
_DRAWS = 512
_cdf = np.vectorize(lambda z: 0.5 * (1 + erf(z / sqrt(2))), otypes=[float])


@dataclass(frozen=True)
class Index:
    """Directions and offsets of all tables, and how vectors are put on the sphere."""

    centre: np.ndarray
    scale: float
    directions: np.ndarray  # tables x axes x (dimensions + 1)
    offsets: np.ndarray  # tables x axes
    sample: np.ndarray  # vectors, put into the unit ball
    rank: int  # of a neighbour in the sample that is as far as a last one among all
    low: int
    buckets: int

    def assumed(self, queries: np.ndarray) -> np.ndarray:
        """How far, on the sphere, the last neighbour of each query may be."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        cosine = np.sort(unit @ self.sample.T, axis=1)[:, ::-1]
        if not cosine.shape[1]:
            return np.ones(len(queries))
        # A query in the sample finds itself first.
        reached = cosine[:, min(self.rank, cosine.shape[1] - 1)]
        return np.maximum(np.sqrt(np.maximum(2 - 2 * reached, 0)), 0.05)

    def cells(self, table: int, vectors: np.ndarray) -> np.ndarray:
        """Bucket numbers, from 0, of vectors on each axis."""
        inside = (vectors - self.centre) / self.scale
        lift = np.sqrt(np.maximum(1 - (inside**2).sum(axis=1, keepdims=True), 0))
        projected = np.hstack([inside, lift]) @ self.directions[table].T + self.offsets[table]
        found = np.floor(projected / WIDTH).astype(np.int64) - self.low
        return np.clip(found, 0, self.buckets - 1)

    def queried(self, table: int, queries: np.ndarray) -> np.ndarray:
        """Projections of query vectors."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        return unit @ self.directions[table][:, :-1].T + self.offsets[table]

    def chances(self, projected: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Log chance of each bucket of each axis (queries x axes x buckets)."""
        edges = (np.arange(self.buckets + 1) + self.low) * WIDTH
        edges[0], edges[-1] = -1e9, 1e9
        below = _cdf((edges[None, None, :] - projected[:, :, None]) / distance[:, None, None])
        return np.log(np.maximum(np.diff(below, axis=2), 1e-12))

    def limits(
        self, projected: np.ndarray, chances: np.ndarray, distance: np.ndarray, seed: int
    ) -> np.ndarray:
        """Per query the log chance of the last cell to visit."""
        draws = np.random.default_rng(seed).normal(size=(_DRAWS, projected.shape[1]))
        total = np.zeros((len(projected), _DRAWS))
        for axis in range(projected.shape[1]):
            moved = projected[:, axis, None] + distance[:, None] * draws[None, :, axis]
            at = np.clip(np.floor(moved / WIDTH).astype(int) - self.low, 0, self.buckets - 1)
            total += np.take_along_axis(chances[:, axis, :], at, axis=1)
        return np.quantile(total, 1 - SUCCESS, axis=1)

    def route(self, cells: np.ndarray) -> np.ndarray:
        """One number for the buckets on the first axes."""
        code = np.zeros(len(cells), dtype=np.int64)
        for axis in range(ROUTED):
            code = code * self.buckets + cells[:, axis]
        return code


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows (id, v) whose vector takes part."""
    bad = F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) | ~F.exists("v", lambda x: x != 0)
    # Floats stay floats, which doubles hold exactly; all others become doubles.
    held = rows.schema[vector].dataType.simpleString()
    kind = held if held == "array<float>" else "array<double>"
    found = rows.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col(vector).cast(kind).alias("v")
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    found = found.where(~F.coalesce(bad, F.lit(True)))
    sizes = found.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    return found.where(F.size("v") == F.lit(most["size"] if most else 0))


def _classes(rows: DataFrame, kept: int) -> DataFrame:
    """Rows (class, v, ids): equal vectors once, with their ``kept`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= kept)
    return few.groupBy("v").agg(
        F.min("id").alias("class"), F.array_sort(F.collect_list("id")).alias("ids")
    )


def _moments(vectors: DataFrame, centre: np.ndarray | None) -> list:
    """Per partition: count and sum, or the largest distance from ``centre``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, largest = 0, None, 0.0
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            n += len(x)
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
            if centre is not None:
                largest = max(largest, float(np.linalg.norm(x - centre, axis=1).max()))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([total.tolist()]), pa.array([largest])],
                names=["n", "total", "largest"],
            )

    return vectors.select("v").mapInArrow(run, "n bigint, total array<double>, largest double").collect()


def fitted(vectors: DataFrame, k: int, seed: int = 11) -> Index | None:
    """Directions, and a sample that tells how far ``k``-th neighbours are."""
    sums = _moments(vectors, None)
    n = sum(row["n"] for row in sums)
    if not n:
        return None
    centre = np.sum([row["total"] for row in sums], axis=0) / n
    scale = max(row["largest"] for row in _moments(vectors, centre)) * (1 + 1e-9) or 1.0
    some = vectors.where(share_of("class", seed) < F.lit(min(1.0, SAMPLE / n))).select("class", "v")
    sample = np.array(
        [row["v"] for row in sorted(some.limit(2 * SAMPLE).collect(), key=lambda r: r["class"])],
        dtype=np.float64,
    ).reshape(-1, len(centre))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(TABLES, AXES, len(centre) + 1))
    offsets = rng.uniform(0, WIDTH, (TABLES, AXES))
    # A k-th neighbour among all is nearer by the sample's share.
    rank = max(1, round(k * len(sample) / n))
    inside = (sample - centre) / scale
    # Unit vectors project to within six standard deviations.
    low = int(np.floor(-6 / WIDTH))
    return Index(
        centre, scale, directions, offsets, inside, rank, low, int(np.ceil((6 + WIDTH) / WIDTH)) - low
    )


def _indexed(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            for t in range(TABLES if len(x) else 0):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), t, dtype=np.int32)),
                        pa.array(index.route(index.cells(t, x))),
                        batch.column("class"),
                        batch.column("v"),
                    ],
                    names=["t", "g", "class", "v"],
                )

    return run


def _probing(index: Index, routes: dict[int, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                q = _matrix(part.column("v"))
                distance = part.column("distance").to_numpy()
                everywhere = part.column("everywhere").to_numpy(zero_copy_only=False)
                for t, codes in routes.items():
                    projected = index.queried(t, q)
                    chances = index.chances(projected, distance)
                    limits = index.limits(projected, chances, distance, t)
                    limits[everywhere] = -np.inf
                    best = chances[:, ROUTED:, :].max(axis=2).sum(axis=1)
                    for code in codes:
                        reach, rest = best.copy(), code
                        for axis in reversed(range(ROUTED)):
                            rest, bucket = divmod(rest, index.buckets)
                            reach += chances[:, axis, bucket]
                        rows = np.flatnonzero(reach >= limits)
                        if len(rows):
                            some = part.take(pa.array(rows))
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(rows), t, dtype=np.int32)),
                                    pa.array(np.full(len(rows), code, dtype=np.int64)),
                                    some.column("class"),
                                    some.column("v"),
                                    pa.array(limits[rows]),
                                    some.column("distance"),
                                ],
                                names=["t", "g", "q", "v", "stop", "distance"],
                            )

    return run


def _searched(index: Index, kept: int):
    """Best candidates of some queries among the cells of some vectors."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if left.num_rows and right.num_rows:
            t = left.column("t")[0].as_py()
            x, q = _matrix(left.column("v")), _matrix(right.column("v"))
            classes = left.column("class").to_numpy()
            cells, cell_of = np.unique(index.cells(t, x), axis=0, return_inverse=True)
            cell_of = cell_of.ravel()
            names = right.column("q").to_numpy()
            stops = right.column("stop").to_numpy()
            chances = index.chances(index.queried(t, q), right.column("distance").to_numpy())
            for at in range(0, len(q), 256):
                some = slice(at, at + 256)
                log_chance = sum(
                    chances[some, axis, :][:, cells[:, axis]] for axis in range(cells.shape[1])
                )
                visited = log_chance >= stops[some, None]
                columns = np.flatnonzero(visited.any(axis=0)[cell_of])
                scores = q[some] @ x[columns].T
                scores[~visited[:, cell_of[columns]]] = -np.inf
                n = min(kept, len(columns))
                if not n:
                    continue
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                rows, places = np.nonzero(np.isfinite(np.take_along_axis(scores, best, axis=1)))
                at_column = columns[best[rows, places]]
                found[0].append(names[some][rows])
                found[1].append(classes[at_column])
                found[2].append(np.einsum("ij,ij->i", q[some][rows], x[at_column]))
        kinds = (np.int64, np.int64, np.float64)
        arrays = [np.concatenate(f) if f else np.empty(0, kind) for f, kind in zip(found, kinds)]
        return pa.table(arrays, names=["q", "class", "score"])

    return run


def _asking(index: Index):
    """Queries with the distance to assume, their length and their product with the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                q = _matrix(part.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("class"),
                        part.column("v"),
                        pa.array(index.assumed(q)),
                        pa.array(np.linalg.norm(q, axis=1)),
                        pa.array(q @ index.centre),
                    ],
                    names=["class", "v", "distance", "length", "centred"],
                )

    return run


def _found(
    placed: DataFrame,
    sizes: DataFrame,
    routes: dict[int, list[int]],
    asked: DataFrame,
    index: Index,
    kept: int,
) -> DataFrame:
    """Rows (q, class, score): candidates in the cells that each query visits."""
    held = placed.schema["v"].dataType.simpleString()
    probes = write_out(
        asked.select("class", "v", "distance", "everywhere").mapInArrow(
            _probing(index, routes),
            f"t int, g bigint, q bigint, v {held}, stop double, distance double",
        ),
        "near-probes",
    )
    loads = sizes.join(probes.groupBy("t", "g").agg(F.count("*").alias("m")), ["t", "g"]).select(
        "t",
        "g",
        F.ceil(F.col("n") / VECTORS).alias("parts"),
        F.ceil(F.col("m") / QUERIES).alias("shares"),
    )
    loads = F.broadcast(write_out(loads, "near-loads"))
    left = placed.join(loads, ["t", "g"]).select(
        "t",
        "g",
        F.pmod(F.xxhash64("class"), F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"),
        "class",
        "v",
    )
    right = probes.join(loads, ["t", "g"]).select(
        "t",
        "g",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("q"), F.col("shares")).alias("share"),
        "q",
        "v",
        "stop",
        "distance",
    )
    key = ["t", "g", "part", "share"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _searched(index, kept), "q bigint, class bigint, score double"
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), "class")
    merged = (
        found.withColumn("place", F.row_number().over(best))
        # Each table may have found the same.
        .where(F.col("place") <= kept * TABLES)
        .groupBy("q", "class")
        .agg(F.max("score").alias("score"))
    )
    return write_out(merged, "near-found")


def _unsure(asked: DataFrame, merged: DataFrame, index: Index, kept: int) -> DataFrame:
    """Queries with too few candidates, or whose last one is farther than assumed."""
    best = Window.partitionBy("q").orderBy(F.desc("score"), "class")
    last = (
        merged.withColumn("place", F.row_number().over(best))
        .where(F.col("place") == kept)
        .select("q", F.col("score").alias("last"))
    )
    cosine = (F.col("last") - F.col("centred")) / (F.col("length") * index.scale)
    # ``greatest`` passes over NULL, which here says that there is no last candidate.
    reached = F.when(F.col("last").isNotNull(), F.sqrt(F.greatest(2 - 2 * cosine, F.lit(0.0))))
    rows = asked.join(last, asked["class"] == last["q"], "left").withColumn("reached", reached)
    unsure = F.col("reached").isNull() | (F.col("reached") > FARTHER * F.col("distance"))
    return write_out(
        rows.where(unsure).select(
            "class",
            "v",
            F.coalesce("reached", F.lit(2.0)).alias("distance"),
            F.col("reached").isNull().alias("everywhere"),
        ),
        "near-unsure",
    )


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, vector: str = "embedding") -> DataFrame:
    """Per row of ``queries``: its ``k`` nearest rows found (query_id, rank, vec_id, score)."""
    spark = rows.sparkSession
    good = write_out(usable(rows, vector), "near-usable")
    vectors = write_out(_classes(good, k + 1), "near-vectors")
    asked = queries.select(F.col("vec_id").cast("bigint").alias("id")).distinct()
    asked = good.join(asked, "id", "left_semi").distinct()
    # A query is known by the class of its vector.
    pairs = asked.join(vectors.select("class", F.col("v").alias("w")), F.col("v") == F.col("w"))
    pairs = write_out(pairs.select(F.col("id").alias("query_id"), "class"), "near-queries")
    index = fitted(vectors, k)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    held = vectors.schema["v"].dataType.simpleString()
    placed = write_out(
        vectors.select("class", "v").mapInArrow(
            _indexed(index), f"t int, g bigint, class bigint, v {held}"
        ),
        "near-placed",
    )
    sizes = placed.groupBy("t", "g").agg(F.count("*").alias("n"))
    # At most as many as there are combinations of buckets on the first axes.
    routes: dict[int, list[int]] = {}
    for row in sizes.select("t", "g").collect():
        routes.setdefault(row["t"], []).append(row["g"])
    distinct_queries = vectors.join(pairs.select("class").distinct(), "class", "left_semi")
    asked = write_out(
        distinct_queries.select("class", "v").mapInArrow(
            _asking(index), f"class bigint, v {held}, distance double, length double, centred double"
        ),
        "near-asked",
    )
    first = asked.withColumn("everywhere", F.lit(False))
    merged = _found(placed, sizes, routes, first, index, k + 1)
    unsure = _unsure(asked, merged, index, k + 1)
    if not unsure.isEmpty():
        more = _found(placed, sizes, routes, unsure, index, k + 1)
        merged = merged.unionByName(more).groupBy("q", "class").agg(F.max("score").alias("score"))
    each = (
        merged.join(vectors.select("class", "ids"), "class")
        .select("q", "score", F.explode("ids").alias("vec_id"))
        .withColumn(
            "place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
        )
        .where(F.col("place") <= k + 1)
    )
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.join(each, pairs["class"] == each["q"])
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
