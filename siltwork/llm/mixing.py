"""Mix sources to target weights by Efraimidis-Spirakis sampling.

A source's size is its number of words. Sources in code point order, NULL last,
take the weights 5, 2, 1 in turn and share a budget of all words; a target stops
at three times its source's size and the excess goes to the others by weight.

A target of more than its source is met by whole epochs first. For the rest a
document draws ``-ln(u) / weight``, where ``u`` comes from a digest of its id and
text and ``weight`` is its quality, and documents are taken in that order until
the prefix sum of their words meets the rest. The document at the edge is taken
if that comes nearer. Draws depend on nothing but the row, so reruns agree.

The order is not sorted as a whole: draws fall into ranges whose sums are added up
per source, and only the range at the edge is sorted. Ranges are even in the draw's
logarithm: of draws ``-ln(u) / weight`` at most ``1 / (e * RANGES)`` are expected in
one, whatever the weights, so no source gathers in a range.

Null and empty texts have no words and draw last; null ids and sources count as
values. Rows that agree in id and text are taken together. Columns named like
those added here are replaced in results. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.text import whole, words
from siltwork.session import write_out

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Ranges of draws that lie between one and ``e`` times as much.
RANGES = 1024
_AFTER_ALL = 2**31 - 1
_DRAW = ("__size", "__key", "__ticket", "__range")


def quality(text: str) -> Column:
    """Weight of a document, 0.05 to 1: the share of letters among its characters."""
    letters = F.length(F.regexp_replace(whole(text), r"[^\p{L}]+", ""))
    return F.lit(0.05) + F.lit(0.95) * letters / F.greatest(F.length(whole(text)), F.lit(1))


def drawn(docs: DataFrame, text: str = "text", seed: int = 17) -> DataFrame:
    """``docs`` with size, draw, ticket (its digest) and range of the draw."""
    ticket = F.md5(
        F.concat_ws(
            ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.md5(whole(text)),
        )
    )
    uniform = (F.conv(F.substr("__ticket", F.lit(1), F.lit(12)), 16, 10).cast("bigint") + 1) / F.lit(
        float(2**48 + 1)
    )
    rows = docs.withColumn("__size", F.size(words(text)).cast("bigint")).withColumn(
        "__ticket", ticket
    )
    rows = rows.withColumn("__key", -F.log(uniform) / quality(text))
    return rows.withColumn("__range", F.floor(RANGES * F.log("__key")).cast("int"))


def targets(sizes: DataFrame, source: str = "source") -> DataFrame:
    """Targets of sources from one row per source with ``source_size``.

    The table of sources is sorted in one task; it has a row per source.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    rows = sizes.withColumn(
        "__weight", F.get(F.array(*[F.lit(w).cast("bigint") for w in WEIGHTS]), turn)
    ).withColumn("__most", MOST_EPOCHS * F.col("source_size"))
    # Sources in the order in which they reach their limit: when all before one
    # stand at theirs, the others share what is left by weight.
    filling = Window.orderBy(F.col("__most") / F.col("__weight"), F.col(source).asc_nulls_last())
    before = F.coalesce(
        F.sum("__most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("__weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    rows = rows.withColumn("__level", (F.sum("source_size").over(everything) - before) / rest)
    below = F.when(F.col("__level") <= F.col("__most") / F.col("__weight"), F.col("__level"))
    return rows.withColumn("__level", F.max(below).over(everything)).select(
        source,
        "source_size",
        F.least(F.col("__most").cast("double"), F.col("__level") * F.col("__weight")).alias(
            "target"
        ),
    )


def cuts(rows: DataFrame, source: str = "source") -> DataFrame:
    """Per source: its target, whole epochs, and the last draw taken besides them.

    ``rows`` come from ``drawn``. ``__cut`` is NULL where no document is taken
    besides the epochs.
    """
    sums = write_out(
        rows.groupBy(source, "__range").agg(F.sum("__size").alias("__words")), "mix-ranges"
    )
    wanted = targets(sums.groupBy(source).agg(F.sum("__words").alias("source_size")), source)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    wanted = write_out(
        wanted.withColumn("__epochs", F.coalesce(epochs, F.lit(0)).cast("bigint")).withColumn(
            "__rest", F.col("target") - F.col("__epochs") * F.col("source_size")
        ),
        "mix-targets",
    )
    so_far = Window.partitionBy(source).orderBy("__range")
    reached = _join(sums, wanted, source).withColumn("__end", F.sum("__words").over(so_far))
    # The edge lies in the first range whose sum exceeds the rest; if none does, after all.
    edge = write_out(
        reached.groupBy(source).agg(
            F.min(F.when(F.col("__end") > F.col("__rest"), F.col("__range"))).alias("__edge"),
            F.min(
                F.when(F.col("__end") > F.col("__rest"), F.col("__end") - F.col("__words"))
            ).alias("__before"),
        ),
        "mix-edges",
    )
    wanted = _join(wanted, edge, source)
    near = _join(
        rows.select(source, "__range", "__key", "__ticket", "__size"),
        wanted.select(source, "__edge", "__before", "__rest"),
        source,
    ).where(F.col("__range") == F.col("__edge"))
    units = near.groupBy(source, "__key", "__ticket", "__before", "__rest").agg(
        F.sum("__size").alias("__words")
    )
    place = Window.partitionBy(source).orderBy("__key", "__ticket")
    end = F.col("__before") + F.sum("__words").over(place)
    taken = units.withColumn("__end", end).where(
        2 * F.col("__end") - F.col("__words") <= 2 * F.col("__rest")
    )
    last = taken.groupBy(source).agg(F.max(F.struct("__key", "__ticket")).alias("__cut"))
    return write_out(_join(wanted, last, source), "mix-cuts")


def mixed(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """``docs`` with size, source_size, target and how often a row is taken (copies)."""
    rows = drawn(docs.drop("size", "source_size", "target", "copies"), text, seed)
    found = _join(rows, cuts(rows, source), source)
    before_edge = F.col("__range") < F.coalesce(F.col("__edge"), F.lit(_AFTER_ALL))
    by_draw = before_edge | F.coalesce(
        (F.col("__range") == F.col("__edge"))
        & (F.struct("__key", "__ticket") <= F.col("__cut")),
        F.lit(False),
    )
    # A rest of nothing takes nothing, not even what lies before the edge.
    copies = F.col("__epochs") + F.when(by_draw & (F.col("__rest") > 0), 1).otherwise(0)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return found.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__size").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
    )


def repeated(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    own = {c: f"__own_{c}" for c in ("size", "source_size", "target", "copies") if c in docs.columns}
    rows = mixed(docs.withColumnsRenamed(own), text, source, seed)
    rows = rows.where(F.col("copies") > 0).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    )
    back = {new: old for old, new in own.items()}
    return rows.drop("size", "source_size", "target", "copies").withColumnsRenamed(back).select(
        *docs.columns
    )


def _join(left: DataFrame, right: DataFrame, source: str) -> DataFrame:
    """Left join on the source, where NULL is a source too."""
    renamed = right.withColumnRenamed(source, "__source")
    shared = [c for c in renamed.columns if c in left.columns]
    return left.join(
        renamed.drop(*shared), left[source].eqNullSafe(renamed["__source"]), "left"
    ).drop("__source")
