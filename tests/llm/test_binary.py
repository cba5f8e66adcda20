import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import binary


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
@settings(max_examples=200, deadline=None)
def test_ranks_survive_coding(values):
    ranks = np.array(values, dtype=np.uint32)
    control, data = binary.encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4)
    assert binary.decode_ranks(control, data, len(values)).tolist() == values


def test_small_ranks_take_one_byte():
    _, data = binary.encode_ranks(np.array([0, 255, 256, 65536, 1 << 24], dtype=np.uint32))
    assert len(data) == 1 + 1 + 2 + 3 + 4


def test_files_hold_every_document_in_order(spark, docs, byte_tokenizer, tmp_path):
    library = Tokenizer.from_file(byte_tokenizer)
    frame = docs().repartition(4)
    path = str(tmp_path / "files")
    binary.write_token_files(frame, path, byte_tokenizer, end_id=0, block_ids=100)
    assert spark.read.parquet(f"{path}/blocks").count() > 3
    rows = binary.read_token_ids(spark, path).orderBy("start").collect()
    ids = [(r.doc_id, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in rows]
    expected = [
        (r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 0])
        for r in frame.collect()
    ]
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted(ids, key=key) == sorted(expected, key=key)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    lengths = [len(x) for _, x in ids]
    assert [r.start for r in rows] == np.cumsum([0, *lengths])[:-1].tolist()
    digests = binary.read_digests(spark, path).orderBy("start").collect()
    crc = [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for _, x in ids]
    assert [(d.n_tokens, d.ids_crc32) for d in digests] == list(zip(lengths, crc, strict=True))
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_empty_table(docs, byte_tokenizer):
    assert binary.token_files(docs([]), byte_tokenizer).collect() == []
