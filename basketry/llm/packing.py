"""Best-fit packing of token sequences into fixed-size training sequences.

``cut`` turns texts into pieces of at most ``capacity`` tokens; ``pack`` gives each piece a
sequence and a place in it. Pieces are dealt by a hash to shards of about ``SHARD_PIECES``
and every shard is packed by best-fit decreasing: longest piece first, each into the open
sequence with the least room that is enough, found in a segment tree over remaining
capacities in logarithmic time. Only a shard's last sequences can have room that pieces of
another shard would have filled, so the loss is a few sequences in tens of thousands.

Cases: a null or empty text is the end id alone; a text of more than ``capacity`` tokens is
cut into full pieces and a shorter last one; repeated rows and null ids are packed each on
their own; an empty table gives an empty result; further columns are ignored by ``cut`` and
kept by ``pack`` (which needs ``length`` and adds ``sequence_id`` and ``offset``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import words
from basketry.llm.encoding import encoder
from basketry.llm.scratch import stored

SHARD_PIECES = 65_536


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids (32-bit little-endian)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, False)
        for batch, data, offsets in words.blocks(batches):
            ids, ends = coder.encode(data, offsets, end_id)
            lengths = np.diff(ends)
            counts = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(lengths)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = ends[doc] + piece * capacity
            places = np.append(begin, ends[-1]).astype(np.int64) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(piece * capacity, pa.int64()),
                    pa.array(np.diff(places) // 4, pa.int64()),
                    pa.Array.from_buffers(
                        pa.large_binary(),
                        len(doc),
                        [None, pa.py_buffer(places), pa.py_buffer(ids.astype("<u4"))],
                    ).cast(pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids binary"
    )


class OpenSequences:
    """Open sequences by the room left in them; a binary tree counts those below each node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.waiting: dict[int, list[int]] = {}

    def add(self, sequence: int, room: int) -> None:
        self.waiting.setdefault(room, []).append(sequence)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``length``, and that room."""
        count, node = self.count, self.leaves + length
        if not count[node]:
            while node & 1 or not count[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node <<= 1
                node += not count[node]
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.waiting[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; equal lengths are taken in the order given."""
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.count_nonzero(lengths == capacity))
    sequence[order[:full]] = np.arange(full)
    opened, trees = full, OpenSequences(capacity)
    for i in order[full:].tolist():
        length = int(lengths[i])
        found = trees.take(length)
        if found is None:
            found = opened, capacity
            opened += 1
        sequence[i], room = found
        offset[i] = capacity - room
        if room > length:
            trees.add(int(sequence[i]), room - length)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (a stored table: it is counted first) with sequence_id and offset.

    Pieces without tokens take no room and no sequence of their own: they stand at the end
    of whichever sequence has no room left or any other, as best fit gives it.
    """
    shards = max(1, round(pieces.count() / shard_pieces))
    columns = pieces.columns
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns("__shard").sort_by([(c, "ascending") for c in columns])
        sequence, offset = best_fit_decreasing(rows["length"].to_numpy(), capacity)
        sequence += key[0].as_py() << 32
        rows = rows.append_column("sequence_id", pa.array(sequence))
        return rows.append_column("offset", pa.array(offset))

    # By the row's place in the stored table too, so that equal rows spread over shards.
    place = F.xxhash64(*columns, F.monotonically_increasing_id())
    shard = F.pmod(place, F.lit(shards))
    return pieces.withColumn("__shard", shard).groupBy("__shard").applyInArrow(one, schema)


def packed(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with the checksum of their ids and their place."""
    pieces = cut(docs, tokenizer, capacity, end_id)
    digest = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stored(digest, "pieces"), capacity)
