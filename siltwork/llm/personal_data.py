"""Personal data by boosted trees over candidate spans.

Generators propose spans of four kinds, with more of them, and looser, than the
strict forms; they may overlap. A span is described by its format (digits, parts,
check digit, separators) and by what stands around it. Boosted trees are fitted
on at most ``MOST_SPANS`` spans of each kind that hold by the strict rules, and as
many that fail them, drawn by hash from the whole table. The former, and the same
values in looser writing, are positive; the same values with a broken check digit,
impossible parts or a wrong number of digits are negative, as are those that
fail. On values kept from the fit, counted in the whole table, each kind gets the
lowest threshold at which ``PRECISION`` of the accepted spans are right. Strict spans
are always accepted; the trees add others. The trees become one SQL expression,
so scoring is part of the scan.

Null and empty texts have no spans. Repeated rows are searched one by one. Other
columns are not read. In an empty table, or one without strict spans, nothing is
fitted and nothing added.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm.text import whole
from siltwork.session import write_out

KINDS = ("email", "ip", "card", "phone")
MOST_SPANS = 2000
PRECISION = 0.98
CONTEXT = 24
_BLOCK = 256

# A run of characters is searched from its first one only, or from the end of the
# match before: other starts inside a run find nothing else, but take long.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9][0-9\x20-]*[0-9]"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser forms.
LOOSE_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT|@)[)\]]\x20?"
    r"[A-Za-z0-9-]{1,63}\x20?(?:\.|[(\[](?:dot|DOT|\.)[)\]])\x20?[A-Za-z]{2,24}"
)
LOOSE_IP = r"(?<![0-9])[0-9]{1,3}(?:\[\.\]|\(\.\))[0-9]{1,3}(?:\[?\(?\.\)?\]?[0-9]{1,3}){2}(?![0-9])"
LOOSE_CARD = r"(?<![0-9])[0-9]{4}[._/][0-9]{4}[._/][0-9]{4}[._/][0-9]{1,7}(?![0-9])"
LOOSE_PHONE = (
    r"(?<![0-9+.-])(?:\([0-9]{2,4}\)\x20?|(?:00)?[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}"
    r"(?![0-9.-])"
)
ANY = r"[0-9@]|[(\[](?:at|AT)[)\]]"
CUES = (
    r"(?i)mail|contact|tel|phone|fon|call|mobil|fax|card|visa|credit|karte|tarjeta|carte"
    r"|\bip\b|host|server|address|adress"
)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n)


def _sums_before(numbers: Column) -> Column:
    """For each element the sum of those before it, added up by blocks."""
    starts = F.sequence(F.lit(0), F.size(numbers) - 1, F.lit(_BLOCK))
    blocks = F.transform(starts, lambda at: _sum(F.slice(numbers, at + 1, _BLOCK)))

    def with_heads(sums: Column) -> Column:
        return F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i)))

    def each(heads: Column) -> Column:
        return F.transform(
            numbers,
            lambda _, i: F.get(heads, F.floor(i / _BLOCK).cast("int"))
            + _sum(F.slice(numbers, i - i % _BLOCK + 1, i % _BLOCK)),
        )

    heads = F.transform(F.array(blocks), with_heads)
    found = F.transform(heads, each)[0]
    return F.when(F.size(numbers) > 0, found).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str, original: Column | None = None) -> Column:
    """Matches of ``pattern`` as structs (s, start, end), in code points, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))

    def placed(both: Column) -> Column:
        strings, between = both["found"], both["gaps"]
        steps = F.transform(
            strings, lambda s, i: F.get(between, i) + F.when(i > 0, F.length(F.get(strings, i - 1))).otherwise(0)
        )
        # Bound to names of lambdas, the arrays are computed once and not per match.
        def from_steps(step: Column) -> Column:
            def from_sums(before: Column) -> Column:
                return F.transform(
                    strings,
                    lambda s, i: F.struct(
                        s.alias("s"),
                        (F.get(before, i) + F.get(step, i)).alias("start"),
                        (F.get(before, i) + F.get(step, i) + F.length(s)).alias("end"),
                    ),
                )

            return F.transform(F.array(_sums_before(step)), from_sums)[0]

        return F.transform(F.array(steps), from_steps)[0]

    one = F.array(F.struct(found.alias("found"), gaps.alias("gaps")))
    return F.transform(one, placed)[0]


def single_separators(text: Column) -> Column:
    """The text with every blank or hyphen beside another one as a line feed.

    In a run of digits and the remaining blanks and hyphens, all stand alone.
    """
    return F.regexp_replace(text, r"(?<=[\x20-])[\x20-]|[\x20-](?=[\x20-])", "\n")


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]+", "")


def passes_luhn(digits: Column) -> Column:
    """Check digit by Luhn's rule; false for no digits."""

    def value(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, doubled).otherwise(digit)

    total = _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), value))
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(F.lit(False))


def _largest_part(s: Column) -> Column:
    """The largest dotted number, 1000 for one of more than four digits."""
    parts = F.split(F.regexp_replace(s, r"[^0-9.]+", ""), r"\.")
    values = F.transform(
        parts, lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) > 4, 1000).otherwise(
            F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0))
        )
    )
    return F.array_max(values)


def strict(kind: str, s: Column) -> Column:
    """Whether a match of a kind's strict form holds."""
    if kind == "ip":
        return _largest_part(s) <= 255
    digits = digits_of(s)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), passes_luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _around(c: Column) -> Column:
    """0 nothing or white space, 1 letter, 2 digit, 3 another character."""
    return (
        F.when(F.coalesce(c, F.lit("")).rlike(r"^\p{L}"), 1)
        .when(F.coalesce(c, F.lit("")).rlike(r"^[0-9]"), 2)
        .when(F.coalesce(c, F.lit("")).rlike(r"^[^\s]"), 3)
        .otherwise(0)
    )


def features(kind: Column, s: Column, before: Column, after: Column) -> Column:
    """Numbers that describe a span of a kind, the last ``CONTEXT`` characters before it, one after."""
    digits = digits_of(s)
    numbers = [
        kind,
        F.length(digits),
        F.when(F.length(digits).between(12, 19), passes_luhn(digits)).otherwise(F.lit(False)).cast("int"),
        F.size(F.split(s, r"[0-9]+")),
        F.when(kind == KINDS.index("ip"), _largest_part(s)).otherwise(0),
        F.length(F.regexp_replace(s, r"[^.]+", "")),
        F.length(F.regexp_replace(s, r"[^A-Za-z]+", "")),
        s.rlike(r"@|[(\[](?:at|AT)[)\]]").cast("int"),
        s.rlike(r"(?:\.|dot[)\]])\x20?[A-Za-z0-9-]+$").cast("int"),
        _around(F.right(before, F.lit(1))),
        _around(after),
        before.rlike(CUES).cast("int"),
    ]
    return F.array(*[n.cast("double") for n in numbers])


#: Kind, pattern, and whether it is the strict form.
GENERATORS: tuple[tuple[str, str, bool], ...] = (
    ("email", EMAIL, True),
    ("ip", IP, True),
    ("card", CARD, True),
    ("phone", PHONE, True),
    ("email", LOOSE_EMAIL, False),
    ("ip", LOOSE_IP, False),
    ("card", LOOSE_CARD, False),
    ("phone", LOOSE_PHONE, False),
)


def candidates(text: Column) -> Column:
    """All proposed spans of a text: structs (kind, s, start, end, sure, before, after)."""
    runs = single_separators(text)

    def described(kind: str, is_strict: bool) -> Callable[[Column], Column]:
        def of(m: Column) -> Column:
            sure = strict(kind, m["s"]) if is_strict else F.lit(False)
            first = F.greatest(m["start"] - CONTEXT, F.lit(0))
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                m["s"].alias("s"),
                m["start"].cast("bigint").alias("start"),
                m["end"].cast("bigint").alias("end"),
                sure.alias("sure"),
                F.substr(text, first + 1, m["start"] - first).alias("before"),
                F.substr(text, m["end"] + 1, F.lit(1)).alias("after"),
            )

        return of

    spans = [
        F.transform(matches(runs if pattern == CARD else text, pattern), described(kind, is_strict))
        for kind, pattern, is_strict in GENERATORS
    ]
    return F.concat(*spans)


@dataclass(frozen=True)
class Model:
    """Trees as SQL over ``features`` (a name to fill in), and a threshold per kind."""

    trees: str
    thresholds: tuple[float, ...]

    def probability(self, numbers: Column) -> Column:
        return F.transform(F.array(numbers), lambda f: self._score(f))[0]

    def _score(self, f: Column) -> Column:
        margin = F.lit(0.0)
        for tree in _parsed(self.trees):
            margin = margin + _expression(tree, f)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def _parsed(description: str) -> list:
    """Trees of a model's description: a number, or (feature, limit, below, above)."""
    trees, lines = [], []
    weight = 1.0

    def tree(at: int):
        line = lines[at]
        if line.startswith("Predict:"):
            return weight * float(line.split(":")[1]), at + 1
        feature, limit = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line).groups()
        below, at = tree(at + 1)
        above, at = tree(at + 1)  # past the line that starts with Else
        return (int(feature), float(limit), below, above), at

    for block in re.split(r"Tree \d+ \(weight ", description)[1:]:
        head, _, body = block.partition("):")
        weight = float(head)
        lines = [line.strip() for line in body.splitlines() if line.strip()]
        trees.append(tree(0)[0])
    return trees


def _expression(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, limit, below, above = tree
    return F.when(F.get(f, F.lit(feature)) <= limit, _expression(below, f)).otherwise(
        _expression(above, f)
    )


def _examples(spans: DataFrame) -> DataFrame:
    """Labelled spans made from strict ones and from those that fail the strict rules."""
    s, kind = F.col("s"), F.col("kind")
    email, ip, card, phone = range(4)
    digits = digits_of(s)
    grouped = F.regexp_replace(digits, r"^(.{4})(.{4})(.{4})", "$1.$2.$3.")
    loose = (
        F.when(kind == email, F.regexp_replace(s, "@", " (at) "))
        .when(kind == ip, F.regexp_replace(s, r"\.", "[.]"))
        .when(kind == card, grouped)
        .otherwise(F.regexp_replace(s, r"^\+[0-9]{1,2}[\x20.-]?", ""))
    )
    last = F.right(digits, F.lit(1)).cast("int")
    broken = (
        F.when(kind == email, F.regexp_replace(s, r"\.", ""))
        .when(kind == ip, F.concat(F.lit("7"), F.regexp_replace(s, r"\.", "99.")))
        .when(kind == card, F.concat(F.expr("left(s, length(s) - 1)"), ((last + 1) % 10).cast("string")))
        .otherwise(F.substr(s, F.lit(1), F.lit(6)))
    )
    short = F.when(kind == card, F.substr(s, F.lit(1), F.lit(9))).when(
        kind == phone, F.concat(s, digits)
    )
    made = F.array(
        F.struct(s.alias("s"), F.col("sure").cast("double").alias("label")),
        *[
            F.struct(F.when(F.col("sure"), x).alias("s"), F.lit(label).alias("label"))
            for x, label in ((loose, 1.0), (broken, 0.0), (short, 0.0))
        ],
    )
    # A value and all forms made of it, or written otherwise, share a fold.
    value = F.regexp_replace(F.lower("s"), "[^a-z0-9]+", "")
    fold = F.pmod(F.xxhash64(value), F.lit(4)).alias("fold")
    rows = spans.select("kind", "before", "after", fold, F.explode(made).alias("x"))
    return rows.where(F.col("x.s").isNotNull()).select(
        "kind",
        "x.label",
        "fold",
        features(F.col("kind"), F.col("x.s"), F.col("before"), F.col("after")).alias("features"),
    )


def sampled(spans: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct spans per kind and ``sure``, whatever their order.

    Of each bucket of hashes the span with the lowest one is kept, so a partition
    sends at most ``most`` rows per kind and ``sure``.
    """
    span = F.struct("s", "before", "after")
    hashed = F.xxhash64("s", "before", "after")
    rows = spans.select("kind", "sure", span.alias("span"), hashed.alias("hash"))
    bucket = F.pmod("hash", F.lit(most)).alias("bucket")
    kept = rows.groupBy("kind", "sure", bucket).agg(
        F.min(F.struct("hash", "span")).alias("lowest")
    )
    return kept.select("kind", "sure", "lowest.span.*")


def fitted(docs: DataFrame, text: str = "text", most_spans: int = MOST_SPANS) -> Model | None:
    """Trees from a sample of the corpus, thresholds from all of it; None without strict spans."""
    source = F.col(text)
    found = docs.where(source.rlike(ANY)).select(F.explode(candidates(source)).alias("c"))
    strict_forms = found.where("length(c.s) <= 200").select(
        "c.kind", "c.s", "c.before", "c.after", "c.sure"
    )
    # The looser generators' spans have no label.
    spans = strict_forms.where(~_loose())
    rows = write_out(_examples(sampled(spans, most_spans)).where("fold <> 0"), "pii-examples")
    classes = rows.agg(F.min("label"), F.max("label")).first()
    if classes[0] != 0.0 or classes[1] != 1.0:
        return None
    learner = GBTClassifier(
        maxIter=12, maxDepth=4, stepSize=0.3, seed=7, labelCol="label", featuresCol="vector"
    )
    # In one order, so that the same table gives the same trees.
    rows = rows.coalesce(1).sortWithinPartitions("kind", "label", "features")
    vectors = rows.select("label", array_to_vector("features").alias("vector"))
    trees = learner.fit(vectors).toDebugString
    model = Model(trees, ())
    scored = _examples(spans).where("fold = 0").select(
        "kind", "label", F.floor(20 * model.probability(F.col("features"))).alias("step")
    )
    counts = scored.groupBy("kind", "step").agg(
        F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")
    )
    return Model(trees, _thresholds(counts.collect()))


def _loose() -> Column:
    """Spans that only a looser generator proposes."""
    s, kind = F.col("s"), F.col("kind")
    forms = [F.lit(False)]
    for name, pattern, is_strict in GENERATORS:
        if not is_strict:
            forms.append((kind == KINDS.index(name)) & s.rlike(f"^(?:{pattern})$"))
    loose = forms[0]
    for form in forms[1:]:
        loose = loose | form
    return loose


def _thresholds(rows) -> tuple[float, ...]:
    """Per kind the lowest of 20 steps at which precision is reached; 2 if none is."""
    found = []
    for kind in range(len(KINDS)):
        steps = {min(int(r["step"]), 19): (r["right"], r["n"]) for r in rows if r["kind"] == kind}
        best, right, n = 2.0, 0.0, 0
        for step in range(19, 0, -1):
            more = steps.get(step, (0.0, 0))
            right, n = right + more[0], n + more[1]
            if n and right >= PRECISION * n:
                best = step / 20
            elif n:
                break
        found.append(best)
    return tuple(found)


def spans(docs: DataFrame, text: str = "text", name: str = "__spans") -> DataFrame:
    """``docs`` with its accepted spans: structs (start, kind, end, sure), in order."""
    model = fitted(docs, text)
    source = whole(text)

    def accepted(c: Column) -> Column:
        if model is None:
            return c["sure"]
        limits = F.array(*[F.lit(t) for t in model.thresholds])
        p = model.probability(features(c["kind"], c["s"], c["before"], c["after"]))
        return F.when(c["sure"], F.lit(True)).otherwise(p >= F.get(limits, c["kind"]))

    kept = F.transform(
        F.filter(candidates(source), accepted),
        lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                           c["sure"].alias("sure")),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,sure:boolean>>")
    found = F.when(source.rlike(ANY), F.array_sort(_not_inside(kept))).otherwise(none)
    return docs.withColumn(name, found)


def _not_inside(kept: Column) -> Column:
    """Sure spans, and others that overlap no sure span of their kind."""

    def of(every: Column) -> Column:
        sure = F.filter(every, lambda c: c["sure"])
        return F.filter(
            F.array_distinct(every),
            lambda c: c["sure"]
            | ~F.exists(
                sure,
                lambda d: (d["kind"] == c["kind"]) & (d["start"] < c["end"]) & (c["start"] < d["end"]),
            ),
        )

    return F.transform(F.array(kept), of)[0]


def joined(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda c: F.concat_ws(
                ":", F.get(names, c["kind"]), c["start"].cast("string"), c["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each accepted span replaced by its kind in brackets; NULL stays NULL.

    Where spans overlap, the one that starts first is named and the others vanish.
    """
    rows = spans(docs, text)
    names = F.array(*[F.lit(f"[{kind}]") for kind in KINDS])
    source, found = whole(text), F.col("__spans")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("done"))

    def step(state: Column, c: Column) -> Column:
        at = state["at"]
        gap = F.substr(source, (at + 1).cast("int"), (c["start"] - at).cast("int"))
        outside = c["start"] >= at
        return F.struct(
            F.greatest(at, c["end"]).alias("at"),
            F.when(outside, F.concat(state["done"], gap, F.get(names, c["kind"])))
            .otherwise(state["done"])
            .alias("done"),
        )

    clean = F.aggregate(
        found,
        start,
        step,
        lambda state: F.concat(state["done"], F.substr(source, (state["at"] + 1).cast("int"))),
    )
    changed = F.when(F.size(found) > 0, clean).otherwise(F.col(text))
    return rows.withColumn(text, changed).select(*docs.columns)
