"""Quality rules as a short-circuit cascade.

Each rule says when a text is rejected. Rules are timed and counted on a few
rows; the cascade then tries them in the order of rejections per second, and a
row that one rule rejects is not put to the later ones. The order changes the
cost only: a text is kept if no rule rejects it.

Null texts have no words. Repeated rows are judged one by one, and rules that are as
good as each other go by name. Columns may have any names; only ``reason`` is replaced.
Texts of any length are judged whole. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm.samples import some_rows
from siltwork.llm.text import whole
from siltwork.session import write_out

SYMBOLS = "#*$%&|<>"
#: Columns computed for a text, in order; a rule names those it needs.
MEASURES: dict[str, tuple[str, ...]] = {
    "__words": (),
    "__lines": (),
    "n_words": ("__words",),
    "word_chars": ("__words",),
    "n_symbols": (),
    "n_shouts": (),
    "n_upper": (),
    "n_lines": ("__lines",),
    "n_dup_lines": ("__lines",),
    "__windows": ("__words",),
    "__repeats": ("__windows",),
    "n_repeat_words": ("__repeats",),
}


#: SQL of the measures over ``__source``, the text, and the measures they name.
_SQL = {
    "__words": r"array_remove(split(__source, r'[\x20\x09-\x0D]+'), '')",
    "__lines": r"filter(split(__source, '\n'), line -> line rlike r'[^\x20\x09-\x0D]')",
    "n_words": "cast(size(__words) as bigint)",
    "word_chars": "cast(length(array_join(__words, '')) as bigint)",
    "n_symbols": "cast(length(regexp_replace(__source, r'[^#*$%&|<>]+', '')) as bigint)",
    "n_shouts": "cast(length(regexp_replace(__source, r'[^!?]+', '')) as bigint)",
    "n_upper": r"cast(length(regexp_replace(__source, r'[^\p{Lu}]+', '')) as bigint)",
    "n_lines": "cast(size(__lines) as bigint)",
    "n_dup_lines": "cast(size(__lines) - size(array_distinct(__lines)) as bigint)",
    # Hashes of all windows of three words, by place.
    "__windows": """
        case when size(__words) >= 3 then transform(sequence(0, size(__words) - 3), i ->
          xxhash64(get(__words, i), get(__words, i + 1), get(__words, i + 2)))
        else cast(array() as array<bigint>) end""",
    # Places of windows found twice or more, ascending.
    "__repeats": """
        case when size(array_distinct(__windows)) < size(__windows) then
          sort_array(array_compact(transform(
            array(array_sort(transform(__windows, (h, i) -> struct(h, i)))),
            pairs -> transform(pairs, (x, i) ->
              case when x.h = get(pairs, i - 1).h or x.h = get(pairs, i + 1).h then x.i end))[0]))
        else cast(array() as array<int>) end""",
    # Words inside at least one repeated window.
    "n_repeat_words": """
        case when size(__repeats) > 0 then aggregate(
          zip_with(__repeats,
                   concat(slice(__repeats, 2, size(__repeats)), array(element_at(__repeats, -1) + 3)),
                   (a, b) -> least(b - a, 3)),
          0L, (total, gap) -> total + gap)
        else 0L end""",
}


def _bound(name: str, value: str, body: str) -> str:
    """SQL in which ``name`` stands for a value that is computed once.

    A column of its own would be spelled out again wherever it is named once a filter
    on the result moves below it; a variable is not.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def needed(names: Sequence[str]) -> list[str]:
    """``names`` and what they are computed from, in the order of ``MEASURES``."""
    wanted = set(names)
    for name in reversed(MEASURES):
        if name in wanted:
            wanted.update(MEASURES[name])
    return [name for name in MEASURES if name in wanted]


def _with_measures(names: Sequence[str], body: str, known: Sequence[str] = ()) -> str:
    """``body`` with the measures it names, but those known, computed around it."""
    for name in reversed([name for name in needed(names) if name not in known]):
        body = _bound(name, _SQL[name], body)
    return body


def _of_text(text: str, body: str) -> Column:
    column = text.replace("`", "``")
    return F.expr(_bound("__source", f"coalesce(`{column}`, '')", body))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over ``measures``; true rejects the text."""

    name: str
    measures: tuple[str, ...]
    rejects: str


RULES = (
    Rule("few words", ("n_words",), "n_words < 50"),
    Rule(
        "repeated words",
        ("n_words", "n_repeat_words"),
        "100 * n_repeat_words > 50 * n_words",
    ),
    Rule("symbols", ("n_words", "n_symbols"), "100 * n_symbols > 20 * n_words"),
    Rule("shouting", ("n_words", "n_shouts"), "100 * n_shouts > 50 * n_words"),
    Rule("upper case", ("word_chars", "n_upper"), "100 * n_upper > 60 * word_chars"),
    Rule("repeated lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 50 * n_lines"),
    Rule("short words", ("n_words", "word_chars"), "word_chars < 2 * n_words"),
    Rule("long words", ("n_words", "word_chars"), "word_chars > 25 * n_words"),
)
BASE = ("few words", "repeated words")


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rate(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def estimate(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 500
) -> list[Estimate]:
    """Cost and share of rejections of each rule on about ``sample_rows`` rows.

    The sample serves to choose an order only, so any rows do. Each rule is run
    alone, twice; the faster run counts, less that of reading the sample.
    """
    sample = some_rows(docs.select(F.col(text)), sample_rows)
    sample = write_out(sample, "quality-sample")

    def timed(rows: DataFrame, rejects: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            started = time.perf_counter()
            found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(rejects).alias("hits")).first()
            best = min(best, time.perf_counter() - started)
            share = found["hits"] / max(found["n"], 1)
        return best, share

    reading, _ = timed(sample, F.length(whole(text)) < 0)
    found = []
    for rule in rules:
        seconds, share = timed(sample, _of_text(text, _with_measures(rule.measures, rule.rejects)))
        found.append(Estimate(rule, max(seconds - reading, 0.0), share))
    return found


def in_order(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejections per second, most first; ties by name."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rate, e.rule.name))]


def _first_rejecting(rules: Sequence[Rule], known: tuple[str, ...] = ()) -> str:
    """SQL of the name of the first rule that rejects, NULL if none does.

    A rule and the measures that only it and later ones need lie in the branch that is
    taken when the rules before it have not rejected.
    """
    if not rules:
        return "cast(null as string)"
    rule = rules[0]
    rest = _first_rejecting(rules[1:], (*known, *needed(rule.measures)))
    name = rule.name.replace("\\", "\\\\").replace("'", "\\'")
    return _with_measures(
        rule.measures, f"case when {rule.rejects} then '{name}' else {rest} end", known
    )


def cascade(
    docs: DataFrame, rules: Sequence[Rule], text: str = "text", reason: str = "rejected_by"
) -> DataFrame:
    """``docs`` with the first rule, in the given order, that rejects; NULL if none.

    A measure is computed only for rows that no earlier rule has rejected. Columns
    named like a measure do not matter.
    """
    return docs.withColumn(reason, _of_text(text, _first_rejecting(rules)))


def passing(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 500
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    order = in_order(estimate(docs, rules, text, sample_rows))
    return docs.where(_of_text(text, _first_rejecting(order)).isNull())


def judged(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 500
) -> DataFrame:
    """Per row: id, the base measures, ``base_failed`` and the cascade's ``kept``."""
    order = in_order(estimate(docs, rules, text, sample_rows))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = " or ".join(f"({rule.rejects})" for rule in rules if rule.name in BASE) or "false"
    kept = f"({_first_rejecting(order, tuple(needed(base)))}) is null"
    fields = ", ".join(f"{name} as {name}" for name in base)
    made = f"struct({fields}, {failed} as base_failed, {kept} as kept)"
    # Bound measures are seen by the whole body, so rules do not compute them again.
    return docs.select("doc_id", _of_text(text, _with_measures(base, made)).alias("__judged")).select(
        "doc_id", "__judged.*"
    )
