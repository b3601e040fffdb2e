"""Conversation structure repair by a generalised LR parser with weighted edits.

A conversation should read, by the first letters of its roles, ``(s?(ua)+)?``. An LR
automaton of that grammar reads the rows in order of turn. Where a row does not
fit, the parser splits: a row is kept (0), gets the role user or assistant (1) or is
deleted (2), and rows with an empty text of those roles are inserted (5). Stacks form a
graph in which equal tops are merged into the one of least (cost, audit), the audit
being the letters K, R, D, I of the edits in order. Two equally dear ways to one top
never start with each other: what follows would be inserts that lead from a top
back to it. So the merged one is the least whatever follows.

Blank rows and rows whose role and text came before must go; a row that does not end
in ``.``, ``!`` or ``?`` costs 5 unless it is deleted.

All rows are sorted by ranges of conversation and turn, so a long conversation lies in
many tasks. What a task holds of one is parsed in segments of bounded size, from every
top that may be on the stack before it. The segments of a conversation are then put
together by their costs and audits alone, and once the way is known, each segment
writes its repaired rows. Only the digest of the repaired rows reads them one after the
other, without holding them.

Null roles and texts are one space; null turns come first, rows of one turn in order of
role and text. A row with an empty role fits nowhere, so it gets a role or goes. Equal
rows are counted before they move. Very long texts are held one segment at a time.
Conversations without an id are one conversation. Columns besides id, turn, role and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.llm.heavy import joined
from siltwork.session import shuffle_partitions, write_out

RULES = (("B", ("u", "a")), ("B", ("s", "u", "a")), ("B", ("B", "u", "a")))
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: A segment ends after so many rows or characters of text.
SEGMENT_ROWS, SEGMENT_CHARS = 1000, 4_000_000
_SPACES = " \t\n\x0b\x0c\r"
_ORDER = ("conv_id", "turn", "role", "text")


def automaton() -> tuple[dict, dict]:
    """States of the LR(0) automaton: (state, symbol) -> state, and state -> finished rule."""
    start = frozenset((rule, 0) for rule in RULES)
    states, shifts, finished = [start], {}, {}
    for i, items in enumerate(states):
        for symbol in sorted({rule[1][at] for rule, at in items if at < len(rule[1])}):
            reached = frozenset(
                (rule, at + 1) for rule, at in items if at < len(rule[1]) and rule[1][at] == symbol
            )
            if reached not in states:
                states.append(reached)
            shifts[i, symbol] = states.index(reached)
        for rule, at in items:
            if at == len(rule[1]):
                finished[i] = rule
    return shifts, finished


SHIFTS, FINISHED = automaton()


@dataclass(frozen=True)
class Node:
    """A stack top; ``below`` is the node it lies on."""

    state: int
    below: Node | None = None

    def read(self, symbol: str) -> Node | None:
        """The top after a symbol and the reduction it completes, if it fits."""
        state = SHIFTS.get((self.state, symbol))
        if state is None:
            return None
        if state not in FINISHED:
            return Node(state, self)
        left, right = FINISHED[state]
        node = self
        for _ in right[1:]:
            node = node.below
        return Node(SHIFTS[node.state, left], node)


def _reachable() -> dict[int, Node]:
    """All stacks that ends of input can leave, by their top; no top lies on two of them."""
    found = {0: Node(0)}
    for node in (waiting := list(found.values())):
        for symbol in "sua":
            after = node.read(symbol)
            if after is not None and after.state not in found:
                found[after.state] = after
                waiting.append(after)
    return found


STACKS = _reachable()
READ = {
    (top, symbol): after.state
    for top, node in STACKS.items()
    for symbol in "sua"
    if (after := node.read(symbol)) is not None
}
ACCEPTING = (0, SHIFTS[0, "B"])
Tops = dict[int, tuple[int, str]]


def _least(tops: Tops, top: int, way: tuple[int, str]) -> bool:
    """Merge a way into the graph's tops; whether it is the new least one."""
    if top not in tops or way < tops[top]:
        tops[top] = way
        return True
    return False


def _inserted(tops: Tops) -> Tops:
    """The tops with those that inserted rows lead to."""
    waiting = list(tops)
    for top in waiting:
        cost, audit = tops[top]
        for symbol in "ua":
            after = READ.get((top, symbol))
            if after is not None and _least(tops, after, (cost + INSERT, audit + "I")):
                waiting.append(after)
    return tops


def _after(tops: Tops, initial: str, must_go: bool, cut_off: bool) -> Tops:
    """The tops after one row."""
    found: Tops = {}
    extra = CUT_OFF if cut_off else 0
    for top, (cost, audit) in tops.items():
        _least(found, top, (cost + DELETE, audit + "D"))
        if must_go:
            continue
        if (after := READ.get((top, initial))) is not None:
            _least(found, after, (cost + extra, audit + "K"))
        for symbol in "ua":
            if (after := READ.get((top, symbol))) is not None:
                _least(found, after, (cost + REROLE + extra, audit + "R"))
    return _inserted(found)


@dataclass
class Segment:
    """Consecutive rows of one conversation."""

    conv_id: int | None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: list = field(default_factory=list)
    rows: list = field(default_factory=list)
    size: int = 0

    def add(self, turn: int | None, role: str, text: str, times: int, earlier: bool) -> None:
        if times == 0:
            return
        initial = role[:1]
        shown = text.strip(_SPACES)
        cut_off = bool(shown) and shown[-1] not in ".!?"
        if not shown:
            self.blank += times
        else:
            self.duplicate += times - (not earlier)
            self.truncated += cut_off and not earlier
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += times - 1
        self.last = initial
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.rows.append((role, text, times, not shown or earlier, cut_off))
        self.size += len(text) + times

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.size >= SEGMENT_CHARS

    def ways(self, start: int) -> Tops:
        """Least (cost, audit) to each top from the top ``start`` before the segment."""
        tops = _inserted({start: (0, "")})
        for role, _, times, must_go, cut_off in self.rows:
            tops = _after(tops, role[:1], must_go, cut_off)
            if times > 1:
                tops = {t: (c + DELETE * (times - 1), a + "D" * (times - 1)) for t, (c, a) in tops.items()}
                tops = _inserted(tops)
        return tops


def _repaired(rows: Iterable, audit: str, top: int) -> Iterator[str]:
    """``role:text`` of the rows that an audit leaves, from a top before them.

    ``rows`` are (role, text, times).
    """
    each = (row for row in rows for _ in range(row[2]))
    for edit in audit:
        role, text = "", ""
        if edit != "I":
            role, text, *_ = next(each)
        if edit == "D":
            continue
        symbol = role[:1]
        if edit != "K":
            symbol = next(s for s in "ua" if (top, s) in READ)
            role = ROLES[symbol]
        top = READ[top, symbol]
        yield f"{role}:{text}"


RESULTS = (
    *("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal"),
    *("cost", "audit", "repaired_sha256"),
)
_WAY = "struct<start:int,finish:int,cost:bigint,audit:string>"
_KEPT = "struct<role:string,text:string,times:bigint>"
_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_WALKED = (
    f"conv_id bigint, part int, seg int, whole boolean, gaps bigint, {_COUNTS}, cost bigint, "
    "audit string, repaired_sha256 string, first string, last string, low bigint, high bigint, "
    f"turns bigint, ways array<{_WAY}>, kept array<{_KEPT}>"
)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def _walk(rows: DataFrame, segment_rows: int) -> DataFrame:
    """Segments of sorted rows; those that are a whole conversation are repaired at once."""
    arrow = _arrow(_WALKED)

    def whole(segment: Segment) -> dict:
        tops = segment.ways(0)
        cost, audit = min(tops[top] for top in ACCEPTING if top in tops)
        text = "\n".join(_repaired(segment.rows, audit, 0))
        turns = segment.turns
        return _counts(segment) | {
            "whole": True,
            "gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
            "cost": cost,
            "audit": audit,
            "repaired_sha256": _sha(text),
        }

    def part_of(segment: Segment, part: int, seg: int) -> dict:
        turns = segment.turns
        return _counts(segment) | {
            "part": part,
            "seg": seg,
            "whole": False,
            "first": segment.first,
            "last": segment.last,
            "low": turns[0] if turns else None,
            "high": turns[-1] if turns else None,
            "turns": len(turns),
            "ways": [
                {"start": start, "finish": top, "cost": cost, "audit": audit}
                for start in STACKS
                for top, (cost, audit) in segment.ways(start).items()
            ],
            "kept": [{"role": r, "text": t, "times": n} for r, t, n, *_ in segment.rows],
        }

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        held, seg, first = None, 0, True
        columns = (*_ORDER, "times", "earlier")
        for batch in batches:
            for conv, turn, role, text, times, earlier in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                if held is not None and held.conv_id != conv:
                    # A task's first and last conversation may go on in another task.
                    yield part_of(held, part, seg) if first or seg else whole(held)
                    held, seg, first = None, 0, False
                elif held is not None and held.full(segment_rows):
                    yield part_of(held, part, seg)
                    held, seg = None, seg + 1
                if held is None:
                    held = Segment(conv)
                held.add(turn, role, text, times, earlier)
        if held is not None:
            yield part_of(held, part, seg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for row in segments(batches):
            made.append(row)
            size += 1 + 1000 * (not row["whole"])
            if size >= 2000:
                yield _batch(made, arrow)
                made, size = [], 0
        if made:
            yield _batch(made, arrow)

    return rows.mapInArrow(run, _WALKED)


def _counts(segment: Segment) -> dict:
    names = ("conv_id", "blank", "duplicate", "truncated", "illegal")
    return {name: getattr(segment, name) for name in names}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "part", "seg"
    )


_CHOSEN = (
    f"conv_id bigint, part int, seg int, start int, finish int, gaps bigint, {_COUNTS}, "
    "cost bigint, audit string"
)


def _choose(segments: DataFrame) -> DataFrame:
    """For each segment the tops before and after it on the conversation's least way.

    The first segment of a conversation carries the conversation's results. What is held
    of a conversation are its audits up to a segment, one per top, and a few numbers.
    """
    arrow = _arrow(_CHOSEN)

    def chosen(rows: list[dict], tops: Tops, came: list[dict], totals: dict) -> Iterator[dict]:
        top = min((top for top in ACCEPTING if top in tops), key=lambda t: tops[t])
        cost, audit = tops[top]
        for row, from_ in zip(reversed(rows), reversed(came)):
            row |= {"start": from_[top], "finish": top}
            top = from_[top]
        rows[0] |= totals | {"cost": cost, "audit": audit}
        rows[0]["gaps"] = totals["high"] - totals["low"] + 1 - totals["turns"] if totals["turns"] else 0
        yield from rows

    def choices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows: list[dict] = []
        for batch in batches:
            for s in batch.to_pylist():
                if rows and rows[0]["conv_id"] != s["conv_id"]:
                    yield from chosen(rows, tops, came, totals)
                    rows = []
                if not rows:
                    tops, came = {0: (0, "")}, []
                    totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
                    totals |= {"low": None, "high": None, "last": None}
                reached: Tops = {}
                from_: dict = {}
                for way in s["ways"]:
                    if way["start"] in tops:
                        cost, audit = tops[way["start"]]
                        if _least(reached, way["finish"], (cost + way["cost"], audit + way["audit"])):
                            from_[way["finish"]] = way["start"]
                tops = reached
                came.append(from_)
                rows.append({name: s[name] for name in ("conv_id", "part", "seg")})
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    totals[name] += s[name]
                if s["last"] is not None:
                    if totals["last"] is not None:
                        totals["illegal"] += totals["last"] + s["first"] not in ("su", "ua", "au")
                    totals["last"] = s["last"]
                if s["turns"]:
                    totals["turns"] += s["turns"] - (s["low"] == totals["high"])
                    totals["high"] = s["high"]
                    if totals["low"] is None:
                        totals["low"] = s["low"]
        if rows:
            yield from chosen(rows, tops, came, totals)

    return _by_conversation(segments.drop("kept")).mapInArrow(_in_batches(choices, arrow), _CHOSEN)


def _in_batches(made, arrow: pa.Schema, most: int = 200):
    """A function of Arrow batches from one that makes rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in made(batches):
            rows.append({name: row.get(name) for name in arrow.names})
            if len(rows) >= most:
                yield _batch(rows, arrow)
                rows = []
        if rows:
            yield _batch(rows, arrow)

    return run


def _written(segments: DataFrame, choice: DataFrame) -> DataFrame:
    """Conversations of several segments: results and the digest of their repaired rows."""
    # Named apart, so that a segment's counts do not meet its conversation's.
    left = segments.select("conv_id", "part", "seg", "ways", "kept")
    right = choice.withColumnsRenamed({c: f"c_{c}" for c in ("conv_id", "part", "seg")})
    both = left.join(
        right,
        F.col("conv_id").eqNullSafe(F.col("c_conv_id"))
        & (F.col("part") == F.col("c_part"))
        & (F.col("seg") == F.col("c_seg")),
    )
    way = F.filter("ways", lambda w: (w["start"] == F.col("start")) & (w["finish"] == F.col("finish")))
    both = both.withColumn("own", way[0]["audit"]).drop("ways", "c_conv_id", "c_part", "c_seg")
    pieces = f"{_CHOSEN}, piece string"
    pieces_arrow = _arrow(pieces)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                kept = [(k["role"], k["text"], k["times"]) for k in row["kept"]]
                lines = list(_repaired(kept, row["own"], row["start"]))
                yield row | {"piece": "\n".join(lines) if lines else None}

    done = f"conv_id bigint, gaps bigint, {_COUNTS}, cost bigint, audit string, repaired_sha256 string"
    done_arrow = _arrow(done)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        head, digest, empty = None, None, True
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if head is None or head["conv_id"] != row["conv_id"]:
                    if head is not None:
                        yield head | {"repaired_sha256": digest.hexdigest()}
                    head, digest, empty = row, hashlib.sha256(), True
                if row["piece"] is not None:
                    digest.update(b"" if empty else b"\n")
                    digest.update(row["piece"].encode("utf-8", "replace"))
                    empty = False
        if head is not None:
            yield head | {"repaired_sha256": digest.hexdigest()}

    made = both.mapInArrow(_in_batches(repair, pieces_arrow, 1), pieces)
    return _by_conversation(made).mapInArrow(_in_batches(hashed, done_arrow), done)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, times) after a damage that the ids decide.

    ``times`` is how often a row is there: 0 if it is dropped, 2 if repeated.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("times"),
    )


def _with_earlier(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``earlier``: role and text came in an earlier turn."""
    rows = rows.groupBy(*_ORDER).agg(F.sum("times").alias("times"))
    said = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"))
    rows = write_out(rows.withColumn("said", said), "turns")
    repeated = write_out(
        rows.where(F.col("times") > 0)
        .groupBy("conv_id", "said")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("turn").alias("first_turn"),
            F.max(F.col("turn").isNull()).alias("has_null"),
        )
        .where("n > 1"),
        "turns-repeated",
    )
    found = joined(rows, repeated, ["conv_id", "said"], "n", how="left")
    first = F.when(F.col("has_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn"))
    earlier = F.col("has_null").isNotNull() & ~F.coalesce(first, F.lit(False))
    return found.select(*_ORDER, "times", earlier.alias("earlier"))


def repaired(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per conversation its faults, the cheapest edits and a digest of the repaired rows.

    ``rows`` as ``damaged`` returns them. Gives conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.
    """
    parts = shuffle_partitions(rows.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    ranged = _with_earlier(rows).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    walked = write_out(_walk(ranged, segment_rows), "turns-walked")
    some = walked.where(~F.col("whole"))
    choice = write_out(_choose(some), "turns-chosen")
    return walked.where("whole").select(*RESULTS).unionByName(_written(some, choice).select(*RESULTS))
