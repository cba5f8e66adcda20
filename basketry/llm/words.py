"""Words of many texts at once, on the bytes of an Arrow column.

A word is a maximal run of bytes outside a set of separators, never across two texts.
All separators are ASCII, so runs of UTF-8 bytes are runs of characters. Each word gets a
64-bit hash (a polynomial over random byte values, then mixed); two different words of a
corpus share one with a probability of about the number of pairs over 2**64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Space, tab, line feed, vertical tab, form feed and carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Text handled at once; arrays of eight bytes per text byte stay small.
BLOCK_BYTES = 1 << 20
#: Text hashed at once.
_SEGMENT = 1 << 18

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, _SEGMENT), base, dtype=_U64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=_U64)
        if size <= 8 * _SEGMENT:
            _powers[base] = known
    return known[:size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, dtype=np.uint8)[first:last], offsets - first


def blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text, or one longer text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            first, last = int(offsets[row]), int(offsets[end])
            yield batch.slice(row, end - row), data[first:last], offsets[row : end + 1] - first
            row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.frombuffer(data.tobytes().lower(), dtype=np.uint8)


def spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (one more at the end)."""
    inside = ~separator[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[0] = after[-1] = False
        inner = offsets[1:-1]
        before[inner[inner < len(data)]] = False
        after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit value per word."""
    out = np.empty(len(starts), dtype=_U64)
    word = 0
    while word < len(starts):
        after = max(int(np.searchsorted(starts, starts[word] + _SEGMENT)), word + 1)
        low, high = int(starts[word]), int(ends[after - 1])
        sums = np.zeros(high - low + 1, dtype=_U64)
        np.cumsum(_BYTE_VALUES[data[low:high]] * _power(_BASE, high - low), out=sums[1:])
        s, e = starts[word:after] - low, ends[word:after] - low
        value = (sums[e] - sums[s]) * _power(_INVERSE, high - low + 1)[s]
        out[word:after] = mix(value + (e - s).astype(_U64))
        word = after
    return out
