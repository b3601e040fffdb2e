"""Phrases, repeated lines and conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siltwork.llm import conversations, lines, phrases
from siltwork.llm.bitsets import has
from siltwork.llm.heavy import joined
from tests.llm.rows import TURN_SCHEMA, odd_turns, turn_rows


# Lines


def _plain_lines(texts, least=5):
    """(lines, dropped, kept text) per (id, text), by counting keys in a dictionary."""
    blanks = " \t\n\x0b\x0c\r"

    def key(line):
        found = "".join(c.lower() if c.isascii() else c for c in line.strip(blanks))
        return found if len(found) >= 40 else None

    holders = {}
    for i, (_, text) in enumerate(texts):
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            holders.setdefault(k, []).append(texts[i][0])
    keeper = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items()
        if len(ids) >= least
    }
    found = []
    for doc_id, text in texts:
        split = (text or "").split("\n")
        kept = [x for x in split if key(x) not in keeper or keeper[key(x)] == doc_id]
        found.append((doc_id, len(split), len(split) - len(kept), "\n".join(kept)))
    return found


def _line_docs():
    rng = random.Random(3)
    shared = [f"shared line number {i} " + "of many documents " * 2 for i in range(8)]
    shared += ["é" * 39, "é" * 40, "ÀB" * 20, "x" * 39]
    texts = [(i, None) for i in range(3)]
    for i in range(3, 120):
        own = [f"only {i} {j} " + "z" * 40 for j in range(rng.randrange(4))]
        picked = rng.sample(shared, 4) + [" \t" + rng.choice(shared).upper() + "\r", ""]
        found = own + picked + [picked[0]]
        rng.shuffle(found)
        texts.append((i if i % 7 else None, "\n".join(found)))
    return texts + texts[-4:]


@pytest.mark.parametrize("bits", [17, 28])
def test_lines_equal_plain_counts(spark, bits):
    """With a filter far too small, too: then all lines are counted."""
    texts = _line_docs()
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    rows = lines.deduplicated(docs, bits=bits).collect()
    found = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows)
    wanted = _plain_lines(texts)
    assert found == Counter(
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in wanted
    )
    kept = Counter((r.doc_id, r.kept_text) for r in rows if r.n_dropped)
    assert kept == Counter((i, text) for i, _, gone, text in wanted if gone)


def test_filter_knows_every_repeated_line_and_few_others(spark):
    many = [f"line that is in two documents {i:020}" for i in range(3000)]
    single = [f"line that is in one document only {i:020}" for i in range(3000)]
    texts = ["\n".join(many[:2000] + single), "\n".join(many), "\n".join(many[2000:] + many[:1])]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    seen = lines.repeat_filter(docs, bits=22)

    def hits(found):
        hashes = [lines.xxh3_64_intdigest(x.encode()) for x in found]
        at = lines.places(np.array(hashes, dtype=np.uint64), 22)
        return has(seen, at).all(axis=1).mean()

    assert hits(many) == 1
    assert hits(single) < 0.01


# Phrases


def _plain_phrases(docs, least, top):
    counts, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        plain = "".join(c.lower() if c.isascii() else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            plain = plain.replace(c, "\n")
        for piece in plain.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            for n, i in itertools.product(range(1, 5), range(len(words))):
                if i + n <= len(words):
                    counts[lang, tuple(words[i : i + n])] += 1
    made = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, phrase), f in made.items():
        for n, i in itertools.product(range(2, len(phrase)), range(len(phrase))):
            part = (lang, phrase[i : i + n])
            if i + n <= len(phrase) and 100 * f >= 80 * made[part]:
                dropped.add(part)
    rows = {}
    for lang, phrase in made.keys() - dropped:
        a = made[lang, phrase]
        cuts = []
        for k in range(1, len(phrase)):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, k, left, right = min(cuts)
        row = (-score, -a, " ".join(phrase).encode(), left, right, total[lang], k)
        rows.setdefault(lang, []).append(row)
    return sorted(
        (lang, rank + 1, row[2].decode(), row[6], -row[1], row[3], row[4], row[5], -row[0])
        for lang, found in rows.items()
        for rank, row in enumerate(sorted(found)[:top])
    )


def _phrase_docs():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(12)] + ["É", "ß", "the", "THE", "na"]
    docs = [(None, None), ("en", ""), ("de", " \t ; . "), ("en", "na " * 300)]
    for i in range(150):
        n = rng.randrange(60)
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(n))
        docs.append((rng.choice(["en", "en", "fr", None, "und"]), text + " fixed phrase of four words"))
    return docs + docs[-5:]


@pytest.mark.parametrize("bits", [17, 27])
def test_phrases_equal_plain_counts(spark, bits):
    docs = _phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    rows = phrases.collocations(df, least=6, top=70, bits=bits).collect()
    assert sorted(map(tuple, rows)) == _plain_phrases(docs, 6, 70)


def test_sections_lose_no_word():
    text = b"aa bb cc.dd " * 50 + b"x" * 300 + b" end\nof it"
    for size in (1, 7, 64, 10_000):
        assert b"".join(phrases._sections(text, size)) == text
        for section in phrases._sections(text, size):
            assert section[-1:] in b" \n" or text.endswith(section)


def test_counts_pass_64_bits(spark):
    """A count of 10 ** 13 times the scale."""
    grams = spark.createDataFrame(
        [("en", "a", "b", None, None, 10**13), ("en", "b", None, None, None, 10**13)],
        "lang string, w1 string, w2 string, w3 string, w4 string, c bigint",
    )
    found, words = phrases.counted(grams)
    assert {(r.phrase, r.a) for r in found.collect()} == {("a b", 10**13), ("a", 10**13), ("b", 10**13)}
    assert words.first()["n"] == 2 * 10**13


# Conversations


def _plain_repair(rows):
    """Cheapest audits of one conversation by trying edits state by state, least first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marked = set(), []
    counts = Counter()
    for turn, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        fault = None
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif shown[-1] not in ".!?":
            fault = "truncated"
        counts[fault] += 1
        seen.add((role, text))
        marked.append((role, text, fault))
    pairs = zip(marked, marked[1:])
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    # From the last row to the first: the least (cost, audit, rows) from each place on.
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    after = {}
    for i in range(len(marked), -1, -1):
        here = {}
        for state in ("", "s", "u", "a"):
            found = []
            if i == len(marked):
                if state in ("", "a"):
                    found.append((0, "", ()))
            else:
                role, text, fault = marked[i]
                cost, audit, left = after[state]
                found.append((cost + 2, "D" + audit, left))
                extra = 5 if fault == "truncated" else 0
                if fault not in ("blank", "duplicate"):
                    if role[:1] and role[:1] in follows[state]:
                        cost, audit, left = after[role[:1]]
                        found.append((cost + extra, "K" + audit, (f"{role}:{text}", *left)))
                    new = "a" if state == "u" else "u"
                    cost, audit, left = after[new]
                    name = {"u": "user", "a": "assistant"}[new]
                    found.append((cost + 1 + extra, "R" + audit, (f"{name}:{text}", *left)))
            here[state] = min(found, default=None)
        for _ in range(4):
            for state in ("", "s", "u", "a"):
                new = "a" if state == "u" else "u"
                if here[new] is not None:
                    cost, audit, left = here[new]
                    name = {"u": "user", "a": "assistant"}[new]
                    made = (cost + 5, "I" + audit, (f"{name}:", *left))
                    here[state] = made if here[state] is None else min(here[state], made)
        after = here
    cost, audit, left = after[""]
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
    faults = (counts["blank"], counts["duplicate"], counts["truncated"])
    return (gaps, *faults, illegal, cost, audit, digest)


def _plain_damage(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept = found.setdefault(conv, [])
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


@pytest.mark.parametrize("segment_rows", [1, 6, 1000])
def test_conversations_equal_plain_search(spark, segment_rows):
    """Whole, and cut into segments that are put together again."""
    how = {"long": 150} if segment_rows == 1 else {}
    turns = odd_turns(spark, **how).repartition(3)
    rows = conversations.repaired(conversations.damaged(turns), segment_rows).collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    wanted = {conv: _plain_repair(kept) for conv, kept in _plain_damage(turn_rows(**how)).items()}
    assert len(rows) == len(found)
    assert found == wanted


def test_automaton_reads_its_grammar():

    for n in range(7):
        for symbols in itertools.product("sua", repeat=n):
            top = 0
            for symbol in symbols:
                top = conversations.READ.get((top, symbol))
            accepted = top in conversations.ACCEPTING
            assert accepted == bool(re.fullmatch("(s?(ua)+)?", "".join(symbols)))


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}.", None, None) for i in range(5000)]
    turns = spark.createDataFrame(rows, TURN_SCHEMA)
    found = conversations.repaired(conversations.damaged(turns), 100).collect()
    assert [tuple(r)[1:] for r in found] == [_plain_repair(_plain_damage(rows)[1])]


# Joins with heavy keys


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_heavy_keys_equals_plain_join(spark, how):
    keys = [None] * 50 + [1] * 9000 + list(range(2, 300)) * 2
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    facts = rows.groupBy("k").count().where("count > 1 and (k is null or k % 3 <> 0)")
    facts = facts.selectExpr("k", "k * 10 as f", "count as n")
    found = joined(rows, facts, "k", "n", how).collect()
    known = {r.k: r.f for r in facts.collect()}
    wanted = [(k, i, known.get(k)) for i, k in enumerate(keys) if how == "left" or k in known]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
