"""Substring dedup: repeats of at least ``length`` words that stand in an earlier document too.

Words are maximal runs without white space, unchanged. A window is ``length`` consecutive words
of one text; a word is removed if a window over it also starts in a document with a smaller
doc_id. Windows are judged on the input, whatever is removed elsewhere.

* Seed. Of the ``length - GRAM + 1`` word groups of ``GRAM`` words in a window the one with the least
  hash is its anchor (the last one of equals), so equal windows have equal anchors at the same
  place, and about two words in ten carry one. Anchors of two documents or more are seeds.
* Extend. From each seed the text is followed both ways as far as windows keep that anchor, at most
  ``length - GRAM`` words to either side; the words passed are its stretch. Occurrences of a seed
  with equal stretches are a class and its first document holds all their windows. Only the
  first document of each class is left to decide, and only if its seed has several classes: there
  the windows themselves are compared.
* Keep maximal repeats. Covered windows that follow each other in both documents are joined to
  one repeat, with its places in both.

Documents meet in aggregates by anchor, stretch and window and in salted joins with the first
document of each, never in pairs of a group, and partial aggregates go before each shuffle. Between
the passes texts stay where they are: which seeds, and which first documents, a pass is about is
sent to the tasks as a bitmap of at most ``FILTER_BITS`` bits, a sieve whose errors cost time but
change nothing. Stretches and windows are compared by 64-bit hashes.

Cases: a null text, or one without words, has none; a text with fewer words than ``length`` is
kept whole; a row without doc_id is kept whole and is no source; rows that share a doc_id do
not count against each other, be they equal or not; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.scratch import importable, stored
from basketry.operators.lookup import salted_join

#: Words of a group among which the anchor of a window is chosen.
GRAM = 5
#: Bits of a bitmap sent to the tasks, at most, and bits for each of its members if they fit.
FILTER_BITS = 1 << 28
_BITS_EACH = 16

_U64 = np.uint64
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = _U64(0x9E6C63D0876A9A63)
_POWERS_KEPT = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1), base, dtype=_U64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=_U64)
        if size <= _POWERS_KEPT:
            _powers[base] = known
    return known[:size]


class _Sequences:
    """Hashes of runs of words of a block of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.first = words.spans(data, offsets)
        value = words.hashes(data, self.starts, self.ends)
        self.size = len(value)
        self.sums = np.zeros(self.size + 1, dtype=_U64)
        np.cumsum(value * _power(_BASE, self.size), out=self.sums[1:])
        self.inverse = _power(_INVERSE, self.size + 1)

    def span(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        value = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
        return words.mix(value + np.asarray(length).astype(_U64) * _LENGTH)


@dataclass
class Stretches:
    """The anchors of a block of texts with their stretches, in order."""

    text: np.ndarray
    start: np.ndarray  # first word of the stretch, in the block
    windows: np.ndarray  # number of windows in it
    anchor: np.ndarray
    stretch: np.ndarray


def stretches(found: _Sequences, length: int) -> Stretches:
    count = found.size - length + 1
    none = np.zeros(0, dtype=np.int64)
    if count <= 0:
        return Stretches(none, none, none, none.astype(_U64), none.astype(_U64))
    gram = min(GRAM, length)
    choices = length - gram + 1
    groups = found.span(np.arange(found.size - gram + 1), gram)
    least = groups[:count].copy()
    at = np.zeros(count, dtype=np.int64)
    for step in range(1, choices):
        other = groups[step : step + count]
        better = other <= least
        least[better] = other[better]
        at[better] = step
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))[:count]
    inside = found.first[1:][text] - np.arange(count) >= length
    window = np.flatnonzero(inside)
    if not len(window):
        return Stretches(none, none, none, none.astype(_U64), none.astype(_U64))
    place = window + at[window]
    new = np.append(True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1))
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(window)))
    start = window[first]
    return Stretches(
        text[start], start, windows, least[start], found.span(start, windows + (length - 1))
    )


def _held(sieve: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (unsigned) have their bit set."""
    place = values & _U64(len(sieve) * 8 - 1)
    return (sieve[place >> _U64(3)] >> (place & _U64(7)).astype(np.uint8)) & 1 == 1


def _sieve(rows: DataFrame, value: Column) -> np.ndarray:
    """A bitmap of the values, bounded by ``FILTER_BITS``."""
    number = rows.count()
    bits = 1 << 15
    while bits < min(FILTER_BITS, number * _BITS_EACH):
        bits *= 2
    place = value.bitwiseAND(F.lit(bits - 1))
    found = rows.select(place.alias("place")).groupBy(
        F.shiftright("place", 15).cast("int").alias("part")
    )
    found = found.agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in found.toLocalIterator():
        out[row["part"] << 12 : (row["part"] + 1) << 12] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy()


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """Anchors of each document, once per block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            found = stretches(_Sequences(data, offsets), length)
            order = np.lexsort((found.anchor, found.text))
            text, anchor = found.text[order], found.anchor[order]
            new = np.append(True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]))[: len(text)]
            ids = _integers(batch, "doc_id")
            yield pa.RecordBatch.from_arrays(
                [_signed(anchor[new]), pa.array(ids[text[new]])], ["anchor", "doc_id"]
            )

    return docs.select("doc_id", "text").mapInArrow(find, "anchor long, doc_id long")


_OCCURRENCE = ["anchor", "stretch", "doc_id", "version", "place"]


def _occurrences(docs: DataFrame, length: int, sieve: np.ndarray) -> DataFrame:
    """Seeds of each document: anchor, stretch and the word it starts at."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            sequences = _Sequences(data, offsets)
            found = stretches(sequences, length)
            seeds = np.flatnonzero(_held(shared.value, found.anchor))
            text = found.text[seeds]
            columns = [
                _signed(found.anchor[seeds]),
                _signed(found.stretch[seeds]),
                pa.array(_integers(batch, "doc_id")[text]),
                pa.array(_integers(batch, "version")[text]),
                pa.array((found.start[seeds] - sequences.first[text]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _OCCURRENCE)

    return docs.mapInArrow(find, ", ".join(f"{name} long" for name in _OCCURRENCE))


_WINDOW = ["hash", "doc_id", "version", "place"]


def _window_rows(docs: DataFrame, length: int, sieve: np.ndarray) -> DataFrame:
    """Every window of the stretches whose ``stretch ^ owner`` is in the sieve."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            sequences = _Sequences(data, offsets)
            found = stretches(sequences, length)
            version, owner = _integers(batch, "version"), _integers(batch, "owner")
            code = found.stretch ^ np.ascontiguousarray(owner[found.text], dtype=np.int64).view(_U64)
            wanted = np.flatnonzero(_held(shared.value, code))
            number = found.windows[wanted]
            within = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
            start = np.repeat(found.start[wanted], number) + within
            text = np.repeat(found.text[wanted], number)
            columns = [
                _signed(sequences.span(start, length)),
                pa.array(_integers(batch, "doc_id")[text]),
                pa.array(version[text]),
                pa.array((start - sequences.first[text]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _WINDOW)

    return docs.mapInArrow(find, ", ".join(f"{name} long" for name in _WINDOW))


def _first(occurrences: DataFrame, key: str, *more: Column) -> DataFrame:
    """The first document of each key, and the last one."""
    return occurrences.groupBy(key).agg(
        F.min(F.struct("doc_id", "place")).alias("source"),
        F.max("doc_id").alias("latest"),
        *more,
    )


_COVER = ("doc_id", "version", "hash", "source", "source_place")


def _covered(occurrences: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """Occurrences of a key whose first document is a smaller one."""
    shared = first.where(F.col("source.doc_id") < F.col("latest"))
    shared = shared.select(
        key, F.col("source.doc_id").alias("source"), F.col("source.place").alias("source_place")
    )
    shared = stored(shared, "shared")
    later = salted_join(occurrences.select(key, "doc_id", "version"), shared, [key], "inner")
    return later.where(F.col("source") < F.col("doc_id")).withColumnRenamed(key, "hash").select(*_COVER)


def _covers(docs: DataFrame, length: int) -> DataFrame:
    """Stretches and windows of documents that stand in a smaller document."""
    seeds = _anchors(docs, length).groupBy("anchor")
    seeds = seeds.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    seeds = stored(seeds.where(F.col("low") < F.col("high")).select("anchor"), "seeds")
    found = stored(_occurrences(docs, length, _sieve(seeds, F.col("anchor"))), "occurrences")
    classes = stored(_first(found, "stretch", F.min("anchor").alias("anchor")), "stretches")
    several = classes.groupBy("anchor").agg(
        F.min("stretch").alias("low"), F.max("stretch").alias("high"),
        F.min("source.doc_id").alias("first"), F.max("latest").alias("last"),
    )
    several = several.where((F.col("low") < F.col("high")) & (F.col("first") < F.col("last")))
    several = stored(several.select("anchor"), "several")
    open_ones = salted_join(classes, several, ["anchor"], "inner")
    open_ones = open_ones.select(F.col("stretch").bitwiseXOR(F.xxhash64("source.doc_id")).alias("code"))
    sieve = _sieve(stored(open_ones, "open"), F.col("code"))
    windows = stored(_window_rows(docs, length, sieve), "windows")
    alike = _covered(found, classes, "stretch")
    return alike.unionByName(_covered(windows, _first(windows, "hash"), "hash"))


_REPEAT = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64()), ("source_start", pa.int64())]
)
_KEPT = (
    "doc_id long, n_words long, n_removed long, text string, "
    "repeats array<struct<start:long,end:long,source:long,source_start:long>>"
)

def _matches(
    sequences: _Sequences, found: Stretches, text: int, covers: dict[str, np.ndarray], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered windows of a text: their first words, and their source and place there."""
    low, high = np.searchsorted(found.text, [text, text + 1])
    number = found.windows[low:high]
    owner = np.repeat(np.arange(low, high), number)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    start = found.start[owner] + within
    known = covers["hash"]

    def look_up(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return known[at] == hashes, at

    whole, at = look_up(found.stretch[owner])
    single, own = look_up(sequences.span(start, length))
    at = np.where(whole, at, own)
    place = covers["source_place"][at] + np.where(whole, within, 0)
    some = whole | single
    return start[some], covers["source"][at][some], place[some]


def _without(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` with ``covers``: words left, and the repeats taken out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            sequences = _Sequences(data, offsets)
            starts, ends, first = sequences.starts, sequences.ends, sequences.first
            listed = batch.column(batch.schema.get_field_index("covers"))
            marks = np.zeros(sequences.size + 1, dtype=np.int64)
            repeats: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            has = np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False))
            found = stretches(sequences, length) if len(has) else None
            for text in has.tolist():
                values = listed[text].values
                covers = {n: values.field(n).to_numpy(zero_copy_only=False) for n in ("hash", "source", "source_place")}
                covers["hash"] = covers["hash"].view(_U64)
                order = np.argsort(covers["hash"])
                covers = {name: column[order] for name, column in covers.items()}
                start, source, place = _matches(sequences, found, text, covers, length)
                np.add.at(marks, start, 1)
                np.add.at(marks, start + length, -1)
                if not len(start):
                    continue
                own = start - first[text]
                new = np.append(
                    True,
                    (own[1:] != own[:-1] + 1) | (source[1:] != source[:-1]) | (place[1:] != place[:-1] + 1),
                )
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(own)) - 1
                repeats[text] = [
                    {"start": int(own[a]), "end": int(own[b]) + length, "source": int(source[a]), "source_start": int(place[a])}
                    for a, b in zip(begin.tolist(), end.tolist(), strict=True)
                ]
            kept = np.flatnonzero(np.cumsum(marks)[:-1] == 0)
            owner = np.searchsorted(first, kept, side="right") - 1
            last = np.append(owner[1:] != owner[:-1], True)[: len(kept)]
            # Bytes of the kept words, and of one separator behind each but a text's last.
            edge = np.zeros(len(data) + 2, dtype=np.int64)
            edge[starts[kept]] += 1
            edge[ends[kept] + ~last] -= 1
            spaced = data.copy()
            spaced[ends[kept][~last]] = 0x20
            chosen = np.cumsum(edge)[: len(data)] > 0
            bytes_before = np.append(0, np.cumsum(chosen))[offsets]
            buffers = [None, pa.py_buffer(np.ascontiguousarray(bytes_before, dtype=np.int64)), pa.py_buffer(spaced[chosen])]
            n_words = np.diff(first)
            left = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(n_words.astype(np.int64)),
                    pa.array((n_words - left).astype(np.int64)),
                    pa.Array.from_buffers(pa.large_string(), batch.num_rows, buffers).cast(pa.string()),
                    pa.array(repeats, pa.list_(_REPEAT)),
                ],
                ["doc_id", "n_words", "n_removed", "text", "repeats"],
            )

    return docs.mapInArrow(cut, _KEPT)


def without_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, the words that stay (joined by one space) and the repeats.

    A repeat has its first word, the word after its last, the smallest document that holds it
    and the word it starts at there; where several documents take turns, so do the repeats.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # What tells texts of one id apart; equal rows are alike in everything.
    rows = rows.withColumn("version", F.xxhash64("doc_id", "text")).withColumn("owner", F.xxhash64("doc_id"))
    covers = stored(_covers(rows.where("doc_id IS NOT NULL AND text IS NOT NULL"), length), "covers")
    cover = F.struct("hash", "source", "source_place")
    listed = covers.groupBy("doc_id", "version").agg(F.collect_set(cover).alias("covers"))
    joined = rows.join(listed, ["doc_id", "version"], "left").select("doc_id", "text", "covers")
    return _without(joined, length)
