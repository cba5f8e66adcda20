"""Token ids in files: frequency-ranked, in byte-aligned variable-length coding.

A folder holds three Parquet tables. ``ranks`` lists the ids by how often they occur.
``blocks`` holds runs of documents in ascending doc_id order: their ids replaced by ranks,
each rank in as many bytes as it needs (1 to 4) in ``data``, and the byte counts, two bits
per rank and four ranks per byte, apart in ``control``. ``parts`` tells how many ids stand
before each part of the order. Frequent ids take one byte; decoding looks up four lengths
per control byte in a table and gathers the data bytes with numpy.

Cases: a null or empty text has the end id alone; null doc_ids come first; repeated doc_ids
stand side by side, ordered by a hash of their ids; an empty table gives empty files; a
long document has a block of its own; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.encoding import encoder
from basketry.llm.scratch import stored
from basketry.session import fresh_path

#: Ids after which a block ends.
BLOCK_IDS = 1 << 20

#: Lengths of the four ranks of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit ranks."""
    sizes = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    padded[: len(ranks)] = sizes - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(
        axis=1, dtype=np.uint8
    )
    four = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), four[np.arange(4) < sizes[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    begin = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[begin].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        out[longer] |= raw[begin[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _binary(data: np.ndarray, places: np.ndarray) -> pa.Array:
    offsets = np.ascontiguousarray(places * data.itemsize, dtype=np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers).cast(pa.binary())


def token_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id and the ids of each document, two bytes each if the vocabulary allows."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, True)
        width = "<u2" if coder.library.get_vocab_size() <= 1 << 16 else "<u4"
        for batch, data, offsets in words.blocks(batches):
            ids, ends = coder.encode(data, offsets, end_id)
            count = pa.array(np.diff(ends), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), count, _binary(ids.astype(width), ends)],
                ["doc_id", "n_tokens", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "doc_id long, n_tokens long, ids binary"
    )
    return rows.withColumn("tie", F.xxhash64("ids"))


def _unpack(column: pa.Array, count: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row and the number of each document."""
    data, offsets = words.text_bytes(column)
    lengths = count.to_numpy(zero_copy_only=False)
    width = 2 if offsets[-1] == 2 * lengths.sum() else 4
    return data.view(f"<u{width}"), lengths


def ranked_ids(tokens: DataFrame) -> DataFrame:
    """Every id that occurs with its rank by frequency, ties to the smaller id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            ids, _ = _unpack(batch.column(0), batch.column(1))
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = tokens.select("ids", "n_tokens").mapInArrow(count, "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "id")  # one row per id of the vocabulary
    return counts.select("id", "n", (F.row_number().over(order) - 1).alias("rank"))


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS
) -> None:
    spark = docs.sparkSession
    tokens = stored(token_ids(docs, tokenizer, end_id), "tokens")
    ranked_ids(tokens).write.parquet(f"{path}/ranks")
    ranks = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()
    # One entry per id of the vocabulary, whatever the corpus.
    table = np.zeros(int(ranks["id"].max()) + 1 if len(ranks) else 0, dtype=np.uint32)
    table[ranks["id"].to_numpy()] = ranks["rank"].to_numpy()
    shared = spark.sparkContext.broadcast(table)

    def block(part: int, number: int, start: int, held: list) -> pa.RecordBatch:
        ids = np.concatenate([x[1] for x in held])
        control, data = encode_ranks(shared.value[ids])
        documents = pa.concat_arrays([x[0] for x in held])
        lengths = np.concatenate([x[2] for x in held])
        one = lambda values: pa.ListArray.from_arrays([0, len(values)], values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                one(documents),
                one(pa.array(lengths, pa.int64())),
                pa.array([control], pa.binary()),
                pa.array([data], pa.binary()),
            ],
            ["part", "block", "start_in_part", "n_ids", "doc_ids", "lengths", "control", "data"],
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start, size, held = TaskContext.get().partitionId(), 0, 0, 0, []
        for batch in batches:
            row, sizes = 0, batch.column(1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            while row < batch.num_rows:
                done = ends[row] - sizes[row]
                end = int(np.searchsorted(ends, done + block_ids - size, side="right"))
                end = min(max(end, row + (not held)), batch.num_rows)
                if end > row:
                    piece = batch.slice(row, end - row)
                    ids, lengths = _unpack(piece.column(2), piece.column(1))
                    held.append((piece.column(0), ids, lengths))
                    size += len(ids)
                if end < batch.num_rows and held:
                    yield block(part, number, start, held)
                    number, start, size, held = number + 1, start + size, 0, []
                row = end
        if held:
            yield block(part, number, start, held)

    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(
        blocks,
        "part int, block int, start_in_part long, n_ids long, doc_ids array<long>,"
        " lengths array<long>, control binary, data binary",
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")
    shared.unpersist()
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_id")
    sizes.select("part", first).write.parquet(f"{path}/parts")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids before each; a row per file is joined to them."""
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/parts")
    joined = blocks.join(parts, "part")
    return joined.withColumn("start", F.col("first_id") + F.col("start_in_part"))


def _decoded(spark: SparkSession, path: str):
    """A function from batches of blocks to (doc_ids, ids, lengths, start) of each."""
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toPandas()["id"]
    shared = spark.sparkContext.broadcast(table.to_numpy(np.uint32))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, count = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                control, data = batch.column(4)[k].as_py(), batch.column(5)[k].as_py()
                ids = shared.value[decode_ranks(control, data, count)]
                lengths = batch.column(3)[k].values.to_numpy()
                yield batch.column(2)[k].values, ids, lengths, start

    return decoded


_BLOCK_COLUMNS = ["start", "n_ids", "doc_ids", "lengths", "control", "data"]


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (32-bit little-endian) of every document in the files."""
    decoded = _decoded(spark, path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for documents, ids, lengths, start in decoded(batches):
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_arrays(
                [documents, pa.array(start + ends[:-1], pa.int64()), _binary(ids, ends)],
                ["doc_id", "start", "ids"],
            )

    blocks = read_blocks(spark, path).select(*_BLOCK_COLUMNS)
    return blocks.mapInArrow(rows, "doc_id long, start long, ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    decoded = _decoded(spark, path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for documents, ids, lengths, start in decoded(batches):
            ends = np.concatenate([[0], np.cumsum(lengths)])
            raw = memoryview(ids.astype("<u4")).cast("B")
            places = (ends * 4).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(places, places[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    documents,
                    pa.array(start + ends[:-1], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    blocks = read_blocks(spark, path).select(*_BLOCK_COLUMNS)
    return blocks.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the files to the shared folder and return what they hold."""
    path = fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
