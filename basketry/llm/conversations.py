"""Repair of conversations: the cheapest edits after which roles alternate as they should.

The rows of a conversation are read by turn (nulls first; rows of one turn by role and by a hash of their text). The first
fault of a row counts: blank (nothing but white space), duplicate (role and text stood in an
earlier row of the conversation), truncated (its last character that is not white is none of
``.!?``). Edits are Keep (0), Rerole to user or assistant (3), Delete (4; blank and duplicate
rows must go) and Insert of an empty user or assistant message (3); a truncated row that is
not deleted adds 3. Afterwards the initials of the roles must read ``(s?(ua)+)?``.

Such edits are paths through a lattice whose nodes are a number of rows read and what the next
role may be (four states). ``cheapest`` searches it from both ends at once: a heap of prefixes and a
heap of suffixes, each node with its cost and its least string of edit initials. Once both
heaps together exceed the best crossing, every crossing of equal cost has been met, and the
least concatenated string of initials is taken. A string of edits fixes its path, so of two
prefixes of equal cost that end in one node neither begins with the other, and the least
prefix and the least suffix of a crossing give its least whole.

Rows are dealt by ranges of (conversation, turn) and sorted, so a conversation may hold any share
of all rows. One that lies whole within a task, in at most ``SEGMENT_ROWS`` rows, is repaired
there. Longer ones, and those at the edges of a task, are cut into segments. Each segment
then gives the costs from each of its four first to each of its four last states, and the order of
their strings; these few numbers are chained per conversation, and each segment makes its
own edits between the states chosen for it. Inserts belong to the segment they precede, so prefixes
that end at a cut are told apart by the cut's order of them alone.

Cases: a null role or text is one space (so such a text is blank); rows with a null conv_id are one
conversation; a role that starts with none of s, u, a must be reroled or deleted; repeated
rows are duplicates; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.llm.scratch import importable, stored

#: Rows, and characters of text, of a conversation that are handled at once.
SEGMENT_ROWS = 1024
SEGMENT_CHARS = 2 << 20

REROLE, DELETE, INSERT, INCOMPLETE = 3, 4, 3, 3

_WHITE = " \t\n\x0b\x0c\r"

# What may come next: 0 anything, 1 user (after system), 2 assistant, 3 user or the end.
_STATES = range(4)
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)

_NO_PATH = -1


def _steps(pattern: str, tail: bool, row: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edits possible at a node: cost, initial and the node they lead to."""
    if row < len(pattern):
        mark = pattern[row]
        yield DELETE, "D", row + 1, state
        if mark != "x":
            added = INCOMPLETE if mark.isupper() else 0
            kept = _KEEP.get((state, mark.lower()))
            if kept is not None:
                yield added, "K", row + 1, kept
            yield REROLE + added, "R", row + 1, _NEXT[state]
    if tail or row < len(pattern):
        yield INSERT, "I", row, _NEXT[state]


def _back_steps(pattern: str, tail: bool, row: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edits that lead to a node: cost, initial and the node they start from."""
    if row > 0:
        mark = pattern[row - 1]
        yield DELETE, "D", row - 1, state
        if mark != "x":
            added = INCOMPLETE if mark.isupper() else 0
            for before in _STATES:
                if _KEEP.get((before, mark.lower())) == state:
                    yield added, "K", row - 1, before
                if _NEXT[before] == state:
                    yield REROLE + added, "R", row - 1, before
    if tail or row < len(pattern):
        for before in _STATES:
            if _NEXT[before] == state:
                yield INSERT, "I", row, before


def _search(pattern: str, entry: int, exits: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """Bidirectional search. Heaps hold (cost, rows away from the start, edits, row, state):
    only Keep is free and it always reads a row, so a node leaves the heap after all nodes that
    lead to it at the same cost, with its least string."""
    last = len(pattern)
    heaps: tuple[list, list] = ([(0, 0, "", 0, entry)], [(0, 0, "", last, s) for s in exits])
    settled: tuple[dict, dict] = ({}, {})
    best: tuple[int, str] | None = None

    def settle(side: int) -> None:
        nonlocal best
        cost, away, edits, row, state = heappop(heaps[side])
        node = (row, state)
        if node in settled[side]:
            return
        settled[side][node] = (cost, edits)
        other = settled[1 - side]
        if node in other:
            met = (cost + other[node][0], edits + other[node][1] if side == 0 else other[node][1] + edits)
            best = met if best is None else min(best, met)
        step = _back_steps if side else _steps
        for more, letter, to_row, to_state in step(pattern, tail, row, state):
            to = (to_row, to_state)
            if to in settled[side]:
                continue
            string = letter + edits if side else edits + letter
            heappush(heaps[side], (cost + more, away + (to_row != row), string, to_row, to_state))
            if to in other:
                rest_cost, rest = other[to]
                met = (cost + more + rest_cost, rest + string if side else string + rest)
                best = met if best is None else min(best, met)

    settle(0)
    for _ in exits:
        settle(1)
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break
        settle(0 if heaps[0][0][0] <= heaps[1][0][0] else 1)
    return best


@lru_cache(maxsize=1 << 14)
def _remembered(
    pattern: str, entry: int, exits: tuple[int, ...], tail: bool
) -> tuple[int, str] | None:
    return _search(pattern, entry, exits, tail)


def cheapest(
    pattern: str, entry: int = 0, exits: tuple[int, ...] = _ENDS, tail: bool = True
) -> tuple[int, str] | None:
    """Least cost and least string of edits from ``entry`` to one of ``exits``, if any.

    ``pattern`` has a letter per row: x for one to be deleted, else s, u, a or o (any other
    role), a capital for a truncated one. Without ``tail`` nothing is inserted at the end.
    """
    search = _remembered if len(pattern) <= 32 else _search
    return search(pattern, entry, exits, tail)


def apply_edits(
    edits: str, entry: int, roles: list[str], texts: list[str]
) -> Iterator[tuple[str, str]]:
    """The messages that remain or come new."""
    row, state = 0, entry
    for edit in edits:
        if edit == "I":
            yield _ROLE[state], ""
            state = _NEXT[state]
            continue
        if edit == "K":
            yield roles[row], texts[row]
            state = _KEEP[state, roles[row][0]]
        elif edit == "R":
            yield _ROLE[state], texts[row]
            state = _NEXT[state]
        row += 1


def _kind(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "o"


def _key(conversation: int | None, role: str, text: str) -> bytes:
    named = f"{conversation}:{len(role)}:{role}:{text}".encode()
    return hashlib.blake2b(named, digest_size=16).digest()


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conversation: int | None, roles: list, texts: list, marks: str, turns: list):
        self.conversation = conversation
        self.roles, self.texts, self.turns = roles, texts, turns
        self.keys = [
            None if mark == "x" else _key(conversation, role, text)
            for mark, role, text in zip(marks, roles, texts, strict=True)
        ]
        self.marks = marks

    def pattern(self, known: set[bytes]) -> tuple[str, int]:
        """A letter per row, for ``cheapest``, and the number of duplicates."""
        seen, out, duplicates = set(known), [], 0
        for key, mark, role in zip(self.keys, self.marks, self.roles, strict=True):
            if key is None:
                out.append("x")
            elif key in seen:
                out.append("x")
                duplicates += 1
            else:
                seen.add(key)
                out.append(_kind(role).upper() if mark == "t" else _kind(role))
        return "".join(out), duplicates

    def counts(self, pattern: str, duplicates: int) -> dict[str, int]:
        initials = [role[:1] for role in self.roles]
        pairs = zip(initials, initials[1:], strict=False)
        return {
            "blank": self.marks.count("x"),
            "duplicate": duplicates,
            "truncated": sum(letter.isupper() for letter in pattern),
            "illegal": sum(not _legal(a + b) for a, b in pairs),
        }


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_MESSAGES = "array<struct<role:string,text:string>>"
_READ = (
    "conv_id long, segment long, whole boolean, "
    + ", ".join(f"{name} long" for name in _COUNTS)
    + f", edits string, messages {_MESSAGES}, turns array<long>, marks string"
)


def _message_rows(messages: Iterator[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": role, "text": text} for role, text in messages]


def _gaps(turns: list[int | None]) -> int:
    known = [turn for turn in turns if turn is not None]
    return known[-1] - known[0] + 1 - len(set(known)) if known else 0


def _whole(segment: _Segment) -> dict:
    pattern, duplicates = segment.pattern(set())
    cost, edits = cheapest(pattern)
    messages = apply_edits(edits, 0, segment.roles, segment.texts)
    return {
        "conv_id": segment.conversation, "whole": True, "gaps": _gaps(segment.turns), "cost": cost,
        "edits": edits, "messages": _message_rows(messages), **segment.counts(pattern, duplicates),
    }


def _part(segment: _Segment) -> dict:
    messages = _message_rows(zip(segment.roles, segment.texts, strict=True))
    return {
        "conv_id": segment.conversation, "whole": False, "messages": messages,
        "turns": segment.turns, "marks": segment.marks,
    }


def _schema(columns: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(columns))


def _batches(rows: Iterator[dict], schema: pa.Schema, chars: int = SEGMENT_CHARS) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number of characters of messages."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(m["text"]) for m in row.get("messages") or ())
        if size > chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _segments(ordered: DataFrame) -> DataFrame:
    """Whole conversations repaired, and segments of the others as they are."""
    schema = _schema(_READ)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Segments in order; the conversations at both ends of the task may go on elsewhere."""
        current: object = None
        started = False  # some row has been read
        inner = False  # the current conversation began in this task, after another one
        parted = False  # a segment of it has been sent
        rows: tuple[list, list, list, list] = ([], [], [], [])
        size = 0

        def close(ends: bool) -> dict:
            nonlocal rows, size
            roles, texts, marks, turns = rows
            segment = _Segment(current, roles, texts, "".join(marks), turns)
            rows, size = ([], [], [], []), 0
            return _whole(segment) if ends and inner and not parted else _part(segment)

        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for conversation, turn, role, text, mark in zip(*columns, strict=True):
                if not started or conversation != current:
                    if started:
                        yield close(ends=True)
                    current, inner, parted, started = conversation, started, False, True
                elif len(rows[0]) >= SEGMENT_ROWS or size >= SEGMENT_CHARS:
                    yield close(ends=False)
                    parted = True
                if mark == "-":  # only says that there is such a conversation
                    continue
                for values, value in zip(rows, (role, text, mark, turn), strict=True):
                    values.append(value)
                size += len(text)
        if started:
            yield close(ends=False)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        first = TaskContext.get().partitionId() << 36
        for number, row in enumerate(cut(batches)):
            yield {**row, "segment": first + number}

    return ordered.mapInArrow(lambda batches: _batches(numbered(batches), schema), _READ)


def _restore(row: dict) -> _Segment:
    messages = row["messages"]
    return _Segment(
        row["conv_id"], [m["role"] for m in messages], [m["text"] for m in messages],
        row["marks"], row["turns"],
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _seen_before(parts: DataFrame) -> DataFrame:
    """For each segment the keys of rows that stood in an earlier segment."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            found = list({key for key in _restore(row).keys if key is not None})
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array([row["segment"]] * len(found), pa.int64())],
                ["key", "segment"],
            )

    keyed = stored(parts.mapInArrow(keys, "key binary, segment long"), "conversation-keys")
    first = keyed.groupBy("key").agg(F.min("segment").alias("first"), F.max("segment").alias("latest"))
    first = first.where(F.col("first") < F.col("latest")).drop("latest")
    again = keyed.join(first, "key").where(F.col("first") < F.col("segment"))
    return again.groupBy("segment").agg(F.collect_list("key").alias("known"))


_TABLE = (
    "conv_id long, segment long, costs array<int>, places array<int>, last array<int>, "
    "blank long, duplicate long, truncated long, illegal long, initials string, "
    "low long, high long, turns long"
)


def _tables(parts: DataFrame) -> DataFrame:
    """What chaining needs of each segment: costs between states, the order of their edits,
    and the counts that add up."""
    schema = _schema(_TABLE)

    def table(row: dict) -> dict:
        segment = _restore(row)
        pattern, duplicates = segment.pattern(set(row["known"] or ()))
        costs, places = [], []
        for entry in _STATES:
            found = [cheapest(pattern, entry, (to,), tail=False) for to in _STATES]
            costs += [_NO_PATH if path is None else path[0] for path in found]
            strings = sorted(path[1] for path in found if path is not None)
            places += [_NO_PATH if path is None else strings.index(path[1]) for path in found]
        ends = [cheapest(pattern, entry) for entry in _STATES]
        known = [turn for turn in segment.turns if turn is not None]
        initials = [role[:1] for role in segment.roles]
        return {
            "conv_id": segment.conversation, "segment": row["segment"], "costs": costs,
            "places": places, "last": [_NO_PATH if path is None else path[0] for path in ends],
            **segment.counts(pattern, duplicates),
            "initials": None if not initials else f"{initials[0] or '-'}{initials[-1] or '-'}",
            "low": known[0] if known else None, "high": known[-1] if known else None,
            "turns": len(set(known)),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(map(table, _rows_of(batches)), schema, chars=1 << 16)

    return parts.mapInArrow(run, _TABLE)


class _Chain:
    """The segments of one conversation so far: for each state the least cost, the order of
    the strings that lead there, and from which state the segment began."""

    def __init__(self, conversation: int | None):
        self.conversation = conversation
        self.cost = {0: 0}
        self.place = {0: 0}
        self.segments: list[int] = []
        self.parents: list[dict[int, int]] = []
        self.totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.low, self.high, self.initial = 0, None, None, ""
        self.row: dict = {}

    def add(self, row: dict) -> None:
        if self.segments:
            self._pass(self.row)
        self.row = row
        self.segments.append(row["segment"])
        for name in self.totals:
            self.totals[name] += row[name]
        if row["initials"]:
            if self.initial and not _legal(self.initial + row["initials"][0]):
                self.totals["illegal"] += 1
            self.initial = row["initials"][1]
        if row["low"] is not None:
            self.turns += row["turns"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def _pass(self, row: dict) -> None:
        """Through a segment that is not the last one."""
        cost, parent, order = {}, {}, {}
        for to in _STATES:
            ways = [
                (self.cost[s] + row["costs"][4 * s + to], self.place[s], s)
                for s in self.cost
                if row["costs"][4 * s + to] != _NO_PATH
            ]
            if ways:
                cost[to], place, parent[to] = min(ways)
                order[to] = (place, row["places"][4 * parent[to] + to])
        self.cost = cost
        self.place = {to: rank for rank, to in enumerate(sorted(order, key=order.__getitem__))}
        self.parents.append(parent)

    def finish(self) -> Iterator[dict]:
        """The states each segment goes from and to; the totals come with the last one."""
        cost, _, state = min(
            (self.cost[s] + self.row["last"][s], self.place[s], s)
            for s in self.cost
            if self.row["last"][s] != _NO_PATH
        )
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        yield {"segment": self.segments[-1], "entry": state, "exit": None, "gaps": gaps, "cost": cost, **self.totals}
        for segment, parent in zip(self.segments[-2::-1], self.parents[::-1], strict=True):
            yield {"segment": segment, "entry": parent[state], "exit": state}
            state = parent[state]


_CHOICE = "segment long, entry int, exit int, " + ", ".join(f"{name} long" for name in _COUNTS)


def _choices(tables: DataFrame) -> DataFrame:
    schema = _schema(_CHOICE)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now: _Chain | None = None
        for row in _rows_of(batches):
            if now is None or now.conversation != row["conv_id"]:
                if now is not None:
                    yield from now.finish()
                now = _Chain(row["conv_id"])
            now.add(row)
        if now is not None:
            yield from now.finish()

    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(lambda batches: _batches(chain(batches), schema, chars=1 << 16), _CHOICE)


_DONE = (
    "conv_id long, segment long, whole boolean, "
    + ", ".join(f"{name} long" for name in _COUNTS)
    + f", edits string, messages {_MESSAGES}"
)


def _edited(parts: DataFrame) -> DataFrame:
    schema = _schema(_DONE)

    def edit(row: dict) -> dict:
        segment = _restore(row)
        pattern, _ = segment.pattern(set(row["known"] or ()))
        entry, end = row["entry"], row["exit"]
        _, edits = cheapest(pattern, entry) if end is None else cheapest(pattern, entry, (end,), tail=False)
        messages = _message_rows(apply_edits(edits, entry, segment.roles, segment.texts))
        return {**{name: row[name] for name in ("conv_id", "segment", "whole", *_COUNTS)}, "edits": edits, "messages": messages}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(map(edit, _rows_of(batches)), schema)

    return parts.mapInArrow(run, _DONE)


def repaired(conversations: DataFrame, dropped: Column | None = None) -> DataFrame:
    """Repaired conversations, in order of ``segment``.

    A row is a whole conversation, or (``whole`` false) a segment of one: its ``edits``,
    a letter for each, and its ``messages`` after them. The counts of faults and the cost are
    of the conversation and stand in its last segment. Rows with ``dropped`` only say that
    there is a conversation.
    """
    spark = importable(conversations.sparkSession)
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.lit(False) if dropped is None else dropped).alias("gone"),
    )
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    mark = (
        F.when(F.col("gone"), "-")
        .when(end == "", "x")
        .when(F.right(end, F.lit(1)).isin(".", "!", "?"), ".")
        .otherwise("t")
    )
    kept_text = F.when(F.col("gone"), "").otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", "role", kept_text.alias("text"), mark.alias("mark"))
    # Equal rows may part anywhere: the last key spreads them over tasks.
    placed = rows.withColumn("hash", F.xxhash64("text"))
    placed = placed.withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    order = ["conv_id", "turn", "role", "hash", "spread"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    read = stored(_segments(dealt.drop("hash", "spread")), "conversations")
    done = read.where("whole").select("conv_id", "segment", "whole", *_COUNTS, "edits", "messages")
    parts = read.where("not whole").drop(*_COUNTS, "edits")
    parts = parts.join(_seen_before(parts), "segment", "left")
    parts = stored(parts, "segments")
    chosen = _choices(_tables(parts))
    return done.unionByName(_edited(parts.join(chosen, "segment")))


def messages(repairs: DataFrame) -> DataFrame:
    """conv_id, segment, place within it, role and text of every repaired message."""
    return repairs.select("conv_id", "segment", F.posexplode("messages").alias("place", "message")).select(
        "conv_id", "segment", "place", "message.role", "message.text"
    )


def digest(repairs: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, all edits and the SHA-256 of its messages.

    The hash of a long conversation reads its segments in order, one after the other, and
    keeps nothing of them; its string of edits is one value by definition.
    """
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    # An empty list is no line at all, a list of one empty line is.
    joined = F.when(F.size("messages") > 0, F.array_join(lines, "\n"))
    listed = repairs.select("conv_id", "segment", "whole", *_COUNTS, "edits", joined.alias("lines"))
    whole = F.sha2(F.coalesce("lines", F.lit("")).cast("binary"), 256)
    done = listed.where("whole").select(
        "conv_id", *_COUNTS, F.col("edits").alias("audit"), whole.alias("repaired_sha256")
    )
    schema = (
        "conv_id long, " + ", ".join(f"{name} long" for name in _COUNTS)
        + ", audit string, repaired_sha256 string"
    )
    arrow = _schema(schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, edits, started = hashlib.sha256(), [], False
        for row in _rows_of(batches):
            edits.append(row["edits"])
            if row["lines"] is not None:
                sha.update(("\n" if started else "").encode() + row["lines"].encode())
                started = True
            if row["cost"] is not None:  # the last one
                out = {name: row[name] for name in ("conv_id", *_COUNTS)}
                out |= {"audit": "".join(edits), "repaired_sha256": sha.hexdigest()}
                yield pa.RecordBatch.from_pylist([out], schema=arrow)
                sha, edits, started = hashlib.sha256(), [], False

    long = listed.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return done.unionByName(long.mapInArrow(join, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv_id:turn``, and ``gone`` for dropped ones.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats
    it and 4 makes its role user. Nulls are one space.
    """
    conv, turn, role, text = (
        F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")
    )
    kind = F.pmod(F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), kind.alias("kind"),
    )
    changed = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy"),
    ).drop("copy")
