import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketry.llm import packing


def plain_best_fit(lengths, capacity):
    """Best fit decreasing by looking at every open sequence."""
    rooms = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= lengths[i]]
        if fits:
            room, k = min(fits)
            rooms[k] -= lengths[i]
        else:
            rooms.append(capacity - lengths[i])
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_sequence(seed):
    random = np.random.default_rng(seed)
    lengths = random.integers(1, 65, 300)
    sequence, offset = packing.best_fit_decreasing(lengths, 64)
    used = np.bincount(sequence, weights=lengths)
    assert sorted((64 - used).tolist()) == plain_best_fit(lengths.tolist(), 64)
    for s in range(len(used)):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()


def test_no_pieces():
    sequence, offset = packing.best_fit_decreasing(np.zeros(0, dtype=np.int64), 64)
    assert len(sequence) == len(offset) == 0


def test_all_rows_are_packed_whole(docs, word_tokenizer):
    library = Tokenizer.from_file(word_tokenizer)
    frame = docs()
    found = packing.packed(frame, word_tokenizer, capacity=256, end_id=1).collect()
    expected = []
    for row in frame.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], dtype="<u4")
            expected.append((row.doc_id, k // 256, k, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r[:5]) for r in found), key=key) == sorted(expected, key=key)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
        assert sum(n for _, n in places) <= 256


def test_shards_and_empty_table(docs, word_tokenizer):
    pieces = packing.cut(docs(), word_tokenizer, 64, 1).drop("ids").cache()
    assert packing.pack(pieces, 64, shard_pieces=50).count() == pieces.count()
    assert packing.packed(docs([]), word_tokenizer).collect() == []


def test_equal_pieces_spread_over_shards(spark):
    pieces = spark.range(2000).selectExpr("7L AS doc_id", "0 AS piece", "0L AS start", "16L AS length")
    found = packing.pack(pieces, 64, shard_pieces=100).collect()
    shards = [row.sequence_id >> 32 for row in found]
    assert len(found) == 2000
    assert max(shards.count(shard) for shard in set(shards)) < 300
