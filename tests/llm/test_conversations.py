"""Conversation repair against plain dynamic programming, all edits of short ones, and cuts."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import conversations as c
from basketry.llm.scratch import importable

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
WHITE = " \t\n\x0b\x0c\r"


def legal(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_marks(rows):
    """One of x (blank or duplicate), t (truncated) and . for each (role, text), with counts."""
    seen, marks, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        inner = text.strip(WHITE)
        if not inner:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif inner[-1] not in ".!?":
            fault = "truncated"
        else:
            fault = None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marks.append({"blank": "x", "duplicate": "x", "truncated": "t", None: "."}[fault])
    return marks, faults


def plain_repair(rows):
    """Least (cost, edits) and the messages, by a table over rows and the last output initial."""
    marks, faults = plain_marks(rows)
    after = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for last, (cost, edits, out) in list(best.items()):
                for new in after[last]:
                    if new != "s":
                        way = (cost + 3, edits + "I", (*out, (name[new], "")))
                        best[new] = min(best.get(new, way), way, key=lambda w: w[:2])
        return best

    best = inserted({"": (0, "", ())})
    for (role, text), mark in zip(rows, marks, strict=True):
        step = {}

        def offer(last, way, step=step):
            step[last] = min(step.get(last, way), way, key=lambda w: w[:2])

        for last, (cost, edits, out) in best.items():
            offer(last, (cost + 4, edits + "D", out))
            if mark == "x":
                continue
            added = 3 if mark == "t" else 0
            for new in after[last]:
                if role[:1] == new:
                    offer(new, (cost + added, edits + "K", (*out, (role, text))))
                if new != "s":
                    offer(new, (cost + 3 + added, edits + "R", (*out, (name[new], text))))
        best = inserted(step)
    cost, edits, out = min((best[last] for last in ("", "a") if last in best), key=lambda w: w[:2])
    assert legal("".join(role[0] for role, _ in out))
    return cost, edits, out, faults


def plain_results(rows):
    found = {}
    for conv in {row[0] for row in rows}:
        kept = plain_damage([row for row in rows if row[0] == conv])
        kept.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        messages = [(role, text) for _, _, role, text in kept]
        cost, edits, out, faults = plain_repair(messages)
        turns = [turn for _, turn, _, _ in kept if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for role, _ in messages]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        text = "\n".join(f"{role}:{text}" for role, text in out)
        found[conv] = (
            gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return found


def results(spark, rows, extra=()):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        frame = frame.withColumn(name, F.lit(1))
    found = c.digest(c.repaired(c.damaged(frame), F.col("gone")))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    listed = [tuple(row) for row in found.collect()]
    assert len(listed) == len({row[0] for row in listed})
    return {row[0]: row[1:] for row in listed}


def random_rows(number, longest, seed):
    """Turns differ within a conversation, so that its order is settled."""
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n", None, "Grüße. ", "dots...", "x" * 300]
    rows = []
    for conv in range(number):
        turns = rng.sample([None, *range(2 * longest)], rng.randint(1, longest))
        for place, turn in enumerate(turns):
            role = ("user", "assistant")[place % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.6 else f"Text {rng.random()}."
            rows.append((None if conv == 0 else conv, turn, role, text))
    return rows


def pattern_rows(pattern):
    name = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    return [
        ("user", "") if x == "x" else (name[x.lower()], f"text {i}" if x.isupper() else f"text {i}.")
        for i, x in enumerate(pattern)
    ]


def test_search_equals_table():
    rng = random.Random(5)
    for _ in range(3000):
        pattern = "".join(rng.choice("sSuUaAoOxuaua") for _ in range(rng.randint(0, 14)))
        assert c.cheapest(pattern) == plain_repair(pattern_rows(pattern))[:2], pattern


def test_table_equals_all_edits():
    """Every string of edits up to a length, tried on every short pattern."""
    for length in range(3):
        for pattern in itertools.product("sUaxo", repeat=length):
            rows = pattern_rows("".join(pattern))
            marks, _ = plain_marks(rows)
            options = []
            for size in range(length, length + 5):
                for edits in itertools.product("DIKR", repeat=size):
                    if sum(e != "I" for e in edits) != length:
                        continue
                    cost, out, place = 0, "", 0
                    for e in edits:
                        expected = "a" if out[-1:] == "u" else "u"
                        if e == "I":
                            cost, out = cost + 3, out + expected
                            continue
                        mark, role = marks[place], rows[place][0]
                        place += 1
                        if e == "D":
                            cost += 4
                        elif mark == "x":
                            break
                        else:
                            cost += (3 if mark == "t" else 0) + (3 if e == "R" else 0)
                            out += role[0] if e == "K" else expected
                    else:
                        if legal(out):
                            options.append((cost, "".join(edits)))
            assert min(options) == plain_repair(rows)[:2]


def test_cut_searches_chain_to_the_whole(monkeypatch):
    """Chains of segments give the same edits as one search over all rows."""
    rng = random.Random(11)
    for _ in range(500):
        pattern = "".join(rng.choice("sSuUaAoOxua") for _ in range(rng.randint(0, 12)))
        cuts = sorted(rng.choices(range(len(pattern) + 1), k=rng.randint(0, 4)))
        pieces = [pattern[a:b] for a, b in itertools.pairwise([0, *cuts, len(pattern)])]
        chain = c._Chain(1)
        for number, piece in enumerate(pieces):
            costs, places = [], []
            for entry in range(4):
                found = [c.cheapest(piece, entry, (to,), tail=False) for to in range(4)]
                strings = sorted(path[1] for path in found if path)
                costs += [-1 if p is None else p[0] for p in found]
                places += [-1 if p is None else strings.index(p[1]) for p in found]
            last = [c.cheapest(piece, entry) for entry in range(4)]
            chain.add(
                {
                    "segment": number, "costs": costs, "places": places, "initials": None, "low": None,
                    "last": [-1 if p is None else p[0] for p in last],
                    **dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0),
                }
            )
        chosen = sorted(chain.finish(), key=lambda row: row["segment"])
        edits = "".join(
            c.cheapest(piece, row["entry"])[1]
            if row["exit"] is None
            else c.cheapest(piece, row["entry"], (row["exit"],), tail=False)[1]
            for piece, row in zip(pieces, chosen, strict=True)
        )
        assert (chosen[-1]["cost"], edits) == c.cheapest(pattern)


def test_conversations_equal_the_plain_results(spark):
    importable(spark)
    rows = random_rows(60, 12, seed=2)
    assert results(spark, rows) == plain_results(rows)


@pytest.mark.parametrize("segment_rows", [1, 3])
def test_long_conversations_are_cut(spark, monkeypatch, segment_rows):
    """The limit travels with the functions, so small segments need a small limit there."""
    importable(spark)
    monkeypatch.setattr(c, "SEGMENT_ROWS", segment_rows)
    rng = random.Random(3)
    rows = random_rows(6, 40, seed=4)
    rows += [
        (77, turn, rng.choice(["user", "assistant", "assistant"]), rng.choice(["Again.", f"New {turn}.", "open"]))
        for turn in range(2500)
    ]
    assert results(spark, rows) == plain_results(rows)


def test_odd_rows(spark):
    importable(spark)
    rows = [
        (1, None, None, None), (1, None, "user", "Hi."), (2, 1, "assistant", "x. " * 100_000),
        (3, 5, "user", "Same."), (3, 5, "user", "Same."), (3, 5, "user", "Same."),
        (None, 1, "user", "No id?"), (None, None, None, None),
    ]
    found = results(spark, rows, extra=("whole", "segment", "gone", "mark", "key"))
    expected = plain_results(rows)
    assert found.keys() == expected.keys()
    for conv in (2, 3, None):
        assert found[conv] == expected[conv]
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:1".encode()) % 20 == 0)
    assert results(spark, [(dropped, 1, "user", "Gone.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    assert results(spark, []) == {}


def test_messages_alternate(spark):
    importable(spark)
    frame = spark.createDataFrame(random_rows(30, 9, seed=9), SCHEMA)
    found = c.messages(c.repaired(frame)).orderBy("conv_id", "segment", "place").collect()
    initials = {}
    for row in found:
        initials[row["conv_id"]] = initials.get(row["conv_id"], "") + row["role"][0]
    assert initials and all(legal(x) for x in initials.values())
