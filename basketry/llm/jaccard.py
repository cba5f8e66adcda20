"""Near duplicates: documents whose sets of word shingles have a Jaccard similarity >= t.

Shingles are 64-bit hashes of ``width`` consecutive words. Documents with equal sets are one
class from the start; a class is named by a 64-bit hash of its set, so all that follows is
by text and never by doc_id. Between classes the candidates come from prefixes:

* Shingles that stand in more than ``FREQUENT`` places are frequent, but at most
  ``FREQUENT_SHARE`` of them, the most frequent of each range of hashes; so their list can be
  sent to every task whatever the corpus. All sets are ordered with rare shingles first (by hash)
  and frequent ones last, which is one order for all sets.
* Of two sets with similarity >= t each lacks at most s = n - ceil(t n) of its n shingles in
  the other, so they share one within the first s + 1 of both. If either has only rare
  shingles there, they share a rare one: each rare shingle of the prefix is a key.
* Otherwise both prefixes reach the frequent shingles. These are dealt by hash to m classes
  and the prefix is extended by m: among s + 1 + m shared shingles there is a rare one or two
  of the same class, so all pairs of frequent shingles within a class are keys. A passage
  that thousands of documents share so brings together only those that consist of little
  else. m grows with the set's size in steps (``_level``), and a set uses its own step and
  the one below, as any partner has the same step as it or the next to it.
* A set with pairs as keys has all its r rare shingles as keys too. Two such sets without a
  common rare shingle differ by at least the rare ones of both, and similar sets by at most
  (1 - t) / (1 + t) of their sizes together. So a pair as key joins only sets whose excesses,
  (1 + t) r - (1 - t) n, add up to 0 or less: texts with a template in common and too much of
  their own meet under no pair at all, however many there are.

Classes that share a key are compared first by bitmaps of about a bit per shingle, whose
distance never exceeds that of the sets, so only pairs that are too far apart are dropped,
and then exactly, on their whole sets. First each class is compared with one class of its
key, that of the least excess (of a rare key, whose sets without another of fitting size are
left out, the smallest). Within keys that still hold
several components after that, of keys with the same classes one is taken, and blocks of its
classes are compared in arrays of finer bitmaps. Under a pair as key these hold the frequent
shingles alone and the rare ones count in full, as none is common. A pair of classes is
compared under the first of the keys they share (of the ``FIRST_KEYS`` first of each class;
under several beyond that), and only those that pass go on. Components of the confirmed links
come from repeated joins to the smallest id.

Cases: a null text, or one without words, is empty, links with nothing and is its own
component; with fewer than ``width`` words the whole sequence is the one shingle; repeated
rows and exact copies are one class; different texts with one doc_id are compared each on its
own; a null doc_id is kept with a null component and links nothing; an empty table gives an
empty result; further columns, of whatever names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.scratch import discard, stored
from basketry.operators.lookup import lookup_join

#: Places a shingle may stand in and still be a key of its own.
FREQUENT = 8
#: Rows of a key that are compared with one another in one task.
KEY_BLOCK = 1024
#: Keys of a class by which a pair that was compared before is told.
FIRST_KEYS = 8
#: Most frequent shingles there can be.
FREQUENT_SHARE = 1_000_000
#: Shingles that are sorted at once before they are sent, and those counted in one group.
SENT_AT_ONCE = 4 << 20
COUNTED_AT_ONCE = 8 << 20

#: Shingles are counted by their first bits. That two share them makes a shingle look more
#: frequent than it is, for all sets alike.
_COUNT_BITS = 32
_U64 = np.uint64
_SEED = _U64(0xA0761D6478BD642F)


def shingles(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and the offsets of each text."""
    lower = words.lower_ascii(data)
    starts, ends, first = words.spans(lower, offsets)
    h = words.hashes(lower, starts, ends)
    counts = np.diff(first)
    texts = len(counts)
    doc = np.repeat(np.arange(texts), counts)
    value = h.copy()
    reach = np.zeros(len(h), dtype=np.int64)  # words of the text from here on
    if len(h):
        reach = first[1:][doc] - np.arange(len(h))
    for k in range(1, width):
        nxt = np.zeros_like(h)
        nxt[: len(h) - k] = h[k:] if k < len(h) else 0
        value = np.where(reach > k, words.mix(value * _SEED + nxt + _U64(k)), value)
    short = counts < width
    valid = np.where(short[doc], np.arange(len(h)) == first[:-1][doc], reach >= width)
    value, doc = value[valid], doc[valid]
    places = np.searchsorted(doc, np.arange(texts + 1))
    for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        value[a:b].sort()
    new = np.ones(len(value), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    new[places[:-1][places[:-1] < len(value)]] = True
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(texts + 1))


def _binary(values: np.ndarray, places: np.ndarray) -> pa.Array:
    offsets = np.ascontiguousarray(places * 8, dtype=np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers).cast(pa.binary())


def _class_id(raw: memoryview | bytes) -> int:
    """The name of a set: the same for equal sets."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _bitmap(value: np.ndarray, size: int | None = None) -> bytes:
    """For each residue of the shingles by a power of two, whether it occurs an odd number of
    times; at least as many bits as shingles, or as ``size``."""
    bits = max(64, 1 << ((len(value) if size is None else size) - 1).bit_length())
    odd = np.bincount((value & _U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _distance(x: bytes, y: bytes) -> int:
    """Differing bits once the longer bitmap is folded to the length of the shorter."""
    a, b = np.frombuffer(x, dtype=_U64), np.frombuffer(y, dtype=_U64)
    if len(a) < len(b):
        a, b = b, a
    a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def sets(texts: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id (null if empty) and a bitmap of every text."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            value, places = shingles(data, offsets, width)
            raw, ends = memoryview(value.tobytes()), places.tolist()
            names: list[int | None] = []
            bitmaps: list[bytes | None] = []
            for a, b in zip(ends, ends[1:], strict=False):
                names.append(_class_id(raw[8 * a : 8 * b]) if b > a else None)
                bitmaps.append(_bitmap(value[a:b]) if b > a else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(places), pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(bitmaps, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "class_id", "bitmap"],
            )

    return texts.select("doc_id", "text_hash", "text").mapInArrow(
        digest, "doc_id long, text_hash long, n_shingles long, class_id long, bitmap binary"
    )


def frequent_shingles(docs: DataFrame, width: int, ranges: int) -> np.ndarray:
    """Frequent shingles (their first 32 bits), ascending.

    Shingles are sent sorted, as differences, a row for each range of hashes that occurs among
    ``SENT_AT_ONCE`` of them, so never more rows than shingles; a range is counted in one task.
    The list is bounded by ``FREQUENT_SHARE``: of a range with more, those in the most places
    are frequent.
    """
    most = max(1, FREQUENT_SHARE // ranges)
    shift = _U64(64 - _COUNT_BITS)

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        value = np.sort(np.concatenate(parts))
        bounds = (np.arange(1, ranges) * (1 << _COUNT_BITS) // ranges).astype(np.uint32)
        places = np.concatenate([[0], np.searchsorted(value, bounds), [len(value)]])
        filled = np.flatnonzero(np.diff(places))
        rows = [_differences(value[places[k] : places[k + 1]]) for k in filled.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(rows, pa.binary())], ["range", "shingles"]
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, data, offsets in words.blocks(batches):
            value, _ = shingles(data, offsets, width)
            held.append((value >> shift).astype(np.uint32))
            if sum(map(len, held)) >= SENT_AT_ONCE:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def count(_: tuple, table: pa.Table) -> pa.Table:
        value = np.concatenate([_sums(x.as_py()) for x in table["shingles"]])
        value.sort()
        new = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
        times = np.diff(np.append(new, len(value)))
        often = np.flatnonzero(times > FREQUENT)
        often = often[np.argsort(-times[often], kind="stable")[:most]]
        return pa.table([pa.array(value[new][often].astype(np.int64))], ["shingle"])

    sent = docs.select("text").mapInArrow(send, "range int, shingles binary")
    found = sent.groupBy("range").applyInArrow(count, "shingle long").toPandas()["shingle"]
    return np.sort(found.to_numpy(dtype=np.int64)).astype(np.uint32)


def _differences(ascending: np.ndarray) -> bytes:
    """Ascending values as differences, each byte of them in a column of its own."""
    steps = np.diff(ascending, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4)
    used = int(np.flatnonzero(steps.any(axis=0))[-1]) + 1 if steps.any() else 1
    return bytes([used]) + steps[:, :used].T.tobytes()


def _sums(packed: bytes) -> np.ndarray:
    used = packed[0]
    columns = np.frombuffer(packed, dtype=np.uint8, offset=1).reshape(used, -1)
    steps = np.zeros((columns.shape[1], 4), dtype=np.uint8)
    steps[:, :used] = columns.T
    return np.cumsum(steps.view("<u4").reshape(-1), dtype=np.uint32)


@lru_cache(maxsize=8)
def _steps(t: Fraction) -> list[int]:
    """Smallest size of each step: just too large to be similar to the smallest before it."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(math.floor(out[-1] / t) + 1)
    return out


@lru_cache(maxsize=1024)
def _classes_of_step(step: int, t: Fraction) -> int:
    """Into how many classes frequent shingles are dealt: a third of what may be lacking."""
    largest = _steps(t)[step + 1]
    return max(1, math.ceil((largest - math.ceil(t * largest) + 1) / 3))


def keys_of(
    value: np.ndarray, is_frequent: np.ndarray, t: Fraction
) -> tuple[np.ndarray, np.ndarray]:
    """The keys of one set of shingles (ascending): rare shingles, and pairs of frequent ones."""
    n = len(value)
    slack = n - -(-t.numerator * n // t.denominator)
    rare = value[~is_frequent]
    base = rare[: slack + 1]
    if len(rare) > slack:
        return base, base[:0]
    often = value[is_frequent]
    out = [base[:0]]
    step = bisect_right(_steps(t), n) - 1
    for level in {step, max(step - 1, 0)}:
        m = _classes_of_step(level, t)
        extended = often[: slack + 1 + m - len(rare)]
        group = (words.mix(extended + _U64(level)) % _U64(m)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        extended, group = extended[order], group[order]
        for distance in range(1, len(extended)):
            same = np.flatnonzero(group[distance:] == group[:-distance])
            if not len(same):
                break
            one, two = extended[same], extended[same + distance]
            out.append(words.mix(words.mix(one + _U64(level + 1)) + two))
    return base, np.unique(np.concatenate(out))


def _are_frequent(value: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    cut = (value >> _U64(64 - _COUNT_BITS)).astype(np.uint32)
    often = np.append(frequent, np.uint32(0))  # never empty; its last place is no match
    at = np.searchsorted(frequent, cut)
    return (often[at] == cut) & (at < len(frequent))


def _excess(n: int, rare: int, t: Fraction) -> int:
    """Of two sets with no rare shingle in common, the sum is above 0 only if they differ by
    too much."""
    up, down = t.numerator, t.denominator
    return (down + up) * rare - (down - up) * n


def postings(texts: DataFrame, width: int, t: Fraction, frequent: np.ndarray) -> DataFrame:
    """key, class_id, step of the set's size, whether the key is a pair (``often``), and the
    excess of the class (0 for rare keys), for every key of every text; equal sets of one
    block come once."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in words.blocks(batches):
            value, places = shingles(data, offsets, width)
            flags = _are_frequent(value, shared.value)
            raw, ends = memoryview(value.tobytes()), places.tolist()
            distinct: dict[int, tuple[int, int]] = {}
            for a, b in zip(ends, ends[1:], strict=False):
                if b > a:
                    distinct[_class_id(raw[8 * a : 8 * b])] = (a, b)
            names = np.array(list(distinct), dtype=np.int64)
            found = [keys_of(value[a:b], flags[a:b], t) for a, b in distinct.values()]
            excess = [_excess(b - a, b - a - int(flags[a:b].sum()), t) for a, b in distinct.values()]
            steps = np.array([bisect_right(_steps(t), b - a) for a, b in distinct.values()], dtype=np.int32)
            for often_too in (False, True):
                keys = [x[often_too] for x in found]
                flat = np.concatenate(keys) if keys else value[:0]
                sizes = [len(x) for x in keys]
                own = np.repeat(np.array(excess, dtype=np.int64), sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat.view(np.int64)),
                        pa.array(np.repeat(names, sizes)),
                        pa.array(np.repeat(steps, sizes)),
                        pa.array(np.full(len(flat), often_too)),
                        pa.array(own if often_too else np.zeros_like(own)),
                    ],
                    ["key", "class_id", "step", "often", "excess"],
                )

    return texts.select("text").mapInArrow(
        send, "key long, class_id long, step int, often boolean, excess long"
    )


def _with_partner(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Whether another row of the key has the same step of size or the next to it."""
    order = np.lexsort((step, key))
    key, step = key[order], step[order]
    close = (key[1:] == key[:-1]) & (step[1:] - step[:-1] <= 1)
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = close
    out[order[:-1]] |= close
    return out


def shared_keys(keyed: DataFrame) -> DataFrame:
    """key, often, class_id, excess and hub (one class of the key) for keys of several classes.

    A rare shingle has few documents, so its rows are sorted into one task and streamed; those
    whose size fits no other one's go, and its hub is the smallest class. A pair can have any number: its hub, the class of the least
    excess, is found by a partial aggregate and joined back, and classes whose excess is too
    large even for the hub go.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        step = np.zeros(0, dtype=np.int32)

        def several(key: np.ndarray, own: np.ndarray, step: np.ndarray) -> pa.RecordBatch:
            new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))[: len(key)]
            key, own, step = key[new], own[new], step[new]
            kept = _with_partner(key, step)
            key, own = key[kept], own[kept]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            hub = np.repeat(own[first], np.diff(np.append(first, len(key))))
            columns = [pa.array(x) for x in (key, own, hub)]
            return pa.RecordBatch.from_arrays(columns, ["key", "class_id", "hub"])

        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            own = np.concatenate([own, batch.column(1).to_numpy()])
            step = np.concatenate([step, batch.column(2).to_numpy()])
            if not len(key):
                continue
            done = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if done:
                yield several(key[:done], own[:done], step[:done])
                key, own, step = key[done:], own[done:], step[done:]
        yield several(key, own, step)

    rare = keyed.where(~F.col("often")).select("key", "class_id", "step")
    rare = rare.repartition("key").sortWithinPartitions("key", "class_id")
    rare = rare.mapInArrow(runs, "key long, class_id long, hub long")
    rare = rare.select("key", F.lit(False).alias("often"), "class_id", F.lit(0).cast("long").alias("excess"), "hub")
    often = keyed.where("often").select("key", "often", "class_id", "excess")
    hubs = often.groupBy("key").agg(
        F.min_by("class_id", "excess").alias("hub"), F.min("excess").alias("least"),
        F.min("class_id").alias("low"), F.max("class_id").alias("high"),
    )
    # Stored, as a tie between classes may be decided otherwise when it is computed again.
    hubs = hubs.where((F.col("low") < F.col("high")) & (F.col("least") <= 0))
    hubs = stored(hubs.select("key", "hub", "least"), "hubs")
    often = often.join(hubs, "key").where(F.col("excess") + F.col("least") <= 0)
    return rare.unionByName(often.drop("least").distinct())


def close_enough(pairs: DataFrame, bitmaps: DataFrame, t: Fraction) -> DataFrame:
    """The pairs whose sizes and bitmaps allow a similarity of ``t``; none that has it goes."""
    up, down = t.numerator, t.denominator
    sides = [
        bitmaps.select(
            F.col("class_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bitmap").alias(f"of_{x}")
        )
        for x in ("a", "b")
    ]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            good = np.zeros(batch.num_rows, dtype=bool)
            # Similar sets differ in at most (1 - t) / (1 + t) of their sizes together.
            most = (down - up) * sizes // (down + up)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
                good[i] = _distance(x.as_buffer(), y.as_buffer()) <= most[i]
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"]
            )

    both = pairs.join(sides[0], "a").join(sides[1], "b")
    both = both.where(down * F.least("n_a", "n_b") >= up * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(near, "a long, b long")


def _distances(flat: np.ndarray, places: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of bitmaps i and j of a row of bitmaps, the longer one folded."""
    words_of = np.diff(places)
    out = np.zeros(len(i), dtype=np.int64)
    sizes = words_of[i] << 32 | words_of[j]
    for size in np.unique(sizes).tolist():
        on = np.flatnonzero(sizes == size)
        x, y = size >> 32, size & 0xFFFFFFFF
        least = min(x, y)
        sides = []
        for index, width in ((i, x), (j, y)):
            bits = flat[places[index[on]][:, None] + np.arange(width)]
            sides.append(np.bitwise_xor.reduce(bits.reshape(len(on), -1, least), axis=1))
        out[on] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1)
    return out


def unconnected_pairs(placed: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) of classes with a common key and different components whose sizes and
    bitmaps allow a similarity of ``t``.

    ``placed`` has key, its number of rows, class_id, component, excess, the first keys of the
    class, and what ``finer_bitmaps`` gives. A key
    with many rows is dealt in blocks, every two of which meet in one task; rows of a key are
    compared there as arrays, and only the pairs that pass leave the task.
    """
    up, down = t.numerator, t.denominator
    blocks = F.ceil(F.col("rows") / KEY_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    dealt = placed.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    columns = ["key", "low", "high", "own", "class_id", "component", "n_shingles", "excess", "apart", "before", "bitmap"]
    before = F.filter("keys", lambda k: k < F.col("key")).alias("before")
    dealt = dealt.withColumn("before", before)
    dealt = dealt.select("key", low, high, *columns[3:]).repartition("key", "low", "high")
    dealt = dealt.sortWithinPartitions("key", "low", "high", "class_id")

    def compare(rows: pa.Table) -> pa.RecordBatch:
        key, low, high, own, ids, component, n, excess, apart = (
            rows[c].to_numpy() for c in columns[:9]
        )
        before = [frozenset(x) for x in rows["before"].to_pylist()]
        data, offsets = words.text_bytes(rows["bitmap"].combine_chunks())
        flat, places = np.ascontiguousarray(data).view(_U64), offsets // 8
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for step in range(1, len(key)):
            i = np.flatnonzero(
                (key[step:] == key[:-step]) & (low[step:] == low[:-step]) & (high[step:] == high[:-step])
            )
            if not len(i):
                break
            j = i + step
            fits = (component[i] != component[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
            fits &= down * np.minimum(n[i], n[j]) >= up * np.maximum(n[i], n[j])
            fits &= excess[i] + excess[j] <= 0
            i, j = i[fits], j[fits]
            most = (down - up) * (n[i] + n[j]) // (down + up)
            near = _distances(flat, places, i, j) + apart[i] + apart[j] <= most
            pairs = zip(i[near].tolist(), j[near].tolist(), strict=True)
            near[near] = [before[x].isdisjoint(before[y]) for x, y in pairs]
            found.append((ids[i[near]], ids[j[near]]))
        a, b = (np.concatenate([f[k] for f in found]) if found else ids[:0] for k in (0, 1))
        once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in once], ["a", "b"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not len(table):
                continue
            names = [table[c].to_numpy() for c in ("key", "low", "high")]
            last = np.ones(len(table), dtype=bool)
            for values in names:
                last &= values == values[-1]
            done = len(table) - int(last.sum())  # the last run may go on
            if done:
                yield compare(table.slice(0, done))
            held = table.slice(done)
        if held is not None:
            yield compare(held)

    return dealt.mapInArrow(runs, "a long, b long")


def _one_text_each(
    texts: DataFrame, classes: DataFrame, wanted: DataFrame
) -> tuple[DataFrame, bool]:
    """class_id and text of the wanted classes, and whether a text may come several times."""
    first = classes.join(wanted, "class_id").select("class_id", "first.doc_id", "first.text_hash")
    first = stored(first, "wanted")
    rows = lookup_join(texts.select("doc_id", "text_hash"), first, ["doc_id", "text_hash"], "inner")
    several = rows.count() > first.count()
    return lookup_join(texts, first, ["doc_id", "text_hash"], "inner").select("class_id", "text"), several


def finer_bitmaps(
    texts: DataFrame, classes: DataFrame, wanted: DataFrame, width: int, frequent: np.ndarray
) -> DataFrame:
    """class_id, often, n_shingles, apart and bitmap, with four bits a shingle, of the wanted
    classes: of all shingles for rare keys, and of the frequent ones for pairs, with the
    others counted in ``apart``."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    found, several = _one_text_each(texts, classes, wanted)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            value, places = shingles(data, offsets, width)
            flags, ends = _are_frequent(value, shared.value), places.tolist()
            for often in (False, True):
                counted = flags if often else np.ones_like(flags)
                bitmaps, apart = [], []
                for a, b in zip(ends, ends[1:], strict=False):
                    part = value[a:b][counted[a:b]]
                    bitmaps.append(_bitmap(part, 4 * (b - a)))
                    apart.append(b - a - len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(bitmaps), often)),
                        pa.array(np.diff(places), pa.int64()),
                        pa.array(apart, pa.int64()),
                        pa.array(bitmaps, pa.binary()),
                    ],
                    ["class_id", "often", "n_shingles", "apart", "bitmap"],
                )

    fine = found.mapInArrow(
        digest, "class_id long, often boolean, n_shingles long, apart long, bitmap binary"
    )
    return fine.dropDuplicates(["class_id", "often"]) if several else fine


def confirmed(
    texts: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, t: Fraction
) -> DataFrame:
    """The pairs (a, b) of classes whose sets have a similarity of at least ``t``.

    Of each class in some pair one text is read; each set meets its pairs in two joins.
    """
    wanted = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    found, several = _one_text_each(texts, classes, wanted)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            value, places = shingles(data, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _binary(value, places)], ["class_id", "shingles"]
            )

    own = found.mapInArrow(whole, "class_id long, shingles binary")
    own = stored(own, "sets")
    if several:
        own = stored(own.dropDuplicates(["class_id"]), "sets")
    left = own.select(F.col("class_id").alias("a"), F.col("shingles").alias("of_a"))
    right = own.select(F.col("class_id").alias("b"), F.col("shingles").alias("of_b"))
    up, down = t.numerator, t.denominator

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), dtype=_U64) for c in (2, 3)
                )
                common = len(x) + len(y) - len(np.union1d(x, y))
                good[i] = down * common >= up * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"]
            )

    both = pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(similar, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """class_id and component (its smallest class) of every class in a link.

    Every round gives each class the smallest label of its neighbours and then that
    label's own label; it ends when a round changes nothing.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = stored(both, "links")
    labels = both.groupBy("a").agg(F.min("b").alias("least"))
    labels = stored(labels.select(F.col("a").alias("class_id"), F.least("a", "least").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("class_id", "b"), "b").groupBy("a")
        near = near.agg(F.min("component").alias("near")).withColumnRenamed("a", "class_id")
        lower = labels.join(near, "class_id").select(
            "class_id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("class_id").alias("component"), F.col("component").alias("further"))
        lower = lower.join(jump, "component", "left").select(
            "class_id", "old", F.least("component", "further").alias("component")
        )
        lower = stored(lower, "labels")
        if lower.where(F.col("old") != F.col("component")).isEmpty():
            return lower.select("class_id", "component")
        labels = lower.select("class_id", "component")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )


def _components_of_rows(docs: DataFrame, width: int, t: Fraction) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id of every row."""
    texts = _texts(docs)
    all_sets = stored(sets(texts, width), "sets")
    known = all_sets.where(F.col("class_id").isNotNull() & F.col("doc_id").isNotNull())
    classes = known.groupBy("class_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    classes = stored(classes, "classes")
    bitmaps = known.select("class_id", "n_shingles", "bitmap").dropDuplicates(["class_id"])
    bitmaps = stored(bitmaps, "bitmaps")
    total = all_sets.agg(F.sum("n_shingles")).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_shingles(texts, width, max(1, partitions, total // COUNTED_AT_ONCE))
    with_id = texts.where(F.col("doc_id").isNotNull())
    keyed = stored(postings(with_id, width, t, frequent), "postings")
    shared = stored(shared_keys(keyed), "shared-keys")
    discard(keyed)

    def links_of(pairs: DataFrame) -> DataFrame:
        return stored(confirmed(texts, classes, pairs, width, t), "confirmed")

    others = shared.where(F.col("hub") != F.col("class_id"))
    first = others.select(F.least("hub", "class_id").alias("a"), F.greatest("hub", "class_id").alias("b"))
    first = stored(first.distinct(), "pairs")
    links = links_of(stored(close_enough(first, bitmaps, t), "near"))
    found = components(links)
    # All pairs with a hub are decided. Of the others, those of keys whose classes are not all
    # connected by now remain.
    placed = others.drop("hub").join(found, "class_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class_id"))
    split = placed.groupBy("key", "often").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("excess").alias("least"), F.count("*").alias("rows"),
        F.min("class_id").alias("from"), F.max("class_id").alias("to"),
        F.bit_xor(F.xxhash64("class_id")).alias("mark"),
    )
    split = split.where((F.col("low") < F.col("high")) & (F.col("least") <= 0))
    # Of keys with the same classes, which count, ends and hashes tell, one is enough.
    split = split.groupBy("often", "rows", "from", "to", "mark", "least").agg(F.min("key").alias("key"))
    placed = placed.join(split.select("key", "often", "rows", "least"), ["key", "often"])
    placed = stored(placed.where(F.col("excess") + F.col("least") <= 0), "placed")
    first_keys = F.slice(F.sort_array(F.collect_list("key")), 1, FIRST_KEYS)
    fine = finer_bitmaps(texts, classes, placed.select("class_id").distinct(), width, frequent)
    fine = fine.join(placed.groupBy("class_id", "often").agg(first_keys.alias("keys")), ["class_id", "often"])
    placed = placed.join(stored(fine, "finer-bitmaps"), ["class_id", "often"])
    second = stored(unconnected_pairs(placed, t).distinct(), "pairs")
    second = stored(second.join(first, ["a", "b"], "left_anti"), "near")
    if not second.isEmpty():
        found = components(links.unionByName(links_of(second)))
    smallest = classes.select("class_id", F.col("first.doc_id").alias("own"))
    linked = found.join(smallest, "class_id")
    least = linked.groupBy("component").agg(F.min("own").alias("component_id"))
    linked = linked.join(least, "component").select("class_id", "component_id")
    named = smallest.join(linked, "class_id", "left")
    named = named.select("class_id", F.coalesce("component_id", "own").alias("component_id"))
    labelled = all_sets.join(named, "class_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return labelled.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 5, threshold: str = "0.8") -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return _components_of_rows(docs, width, Fraction(threshold)).drop("text_hash")


def distinct_documents(docs: DataFrame, width: int = 5, threshold: str = "0.8") -> DataFrame:
    """The rows of ``docs`` that stand for their group, one for each; all columns as they were.

    Of a group the row with the smallest doc_id stays, and of unlike texts of one group with
    that id the one with the smallest hash. An id may stand on texts of several groups, each of
    which keeps its own. Rows without words or without an id have no group and stay, but rows
    equal in id and text stay once.
    """
    found = stored(_components_of_rows(docs, width, Fraction(threshold)), "components")
    found = found.where(F.col("doc_id").isNotNull())
    worded = found.where(F.col("n_shingles") > 0)
    first = worded.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    # Only the other rows of groups with several are listed.
    others = worded.join(first, "component_id").where(F.struct("doc_id", "text_hash") != F.col("first"))
    row_key = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")]
    others = stored(others.select(*row_key).distinct(), "others")
    again = found.groupBy("doc_id", "text_hash").count().where(F.col("count") > 1)
    again = stored(again.select(*row_key), "repeated-rows")
    boxed = docs.select(
        F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long").alias("__id"),
        F.xxhash64("text").alias("__hash"),
    )
    kept = boxed.join(others, ["__id", "__hash"], "left_anti")
    if again.isEmpty():
        return kept.select("__row.*")
    single = kept.join(again, ["__id", "__hash"], "left_anti")
    repeated = kept.join(again, ["__id", "__hash"], "left_semi").groupBy("__id", "__hash")
    once = repeated.agg(F.min_by("__row", F.xxhash64(F.to_json("__row"))).alias("__row"))
    return single.select("__row.*").unionByName(once.select("__row.*"))
