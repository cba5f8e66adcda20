import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import ann


def plain(rows, k):
    """(query, rank, id) by comparing every query with every row."""
    unique = {i: np.array(v) for i, v in rows if i is not None and usable(v)}
    out = []
    for q in sorted(unique):
        if q % 20:
            continue
        others = [(-float(unique[q] @ v), i) for i, v in unique.items() if i != q]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(others)[:k], 1)]
    return out


def usable(v):
    return v is not None and None not in v and np.isfinite(v).all() and np.any(v)


@pytest.fixture(scope="module")
def frame(docs, spark):
    return lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def found(frame, rows, **options):
    table = frame([(i, v, 0) for i, v in rows])
    result = ann.nearest(table, F.col("vec_id") % 20 == 0, **options)
    return sorted(tuple(r) for r in result.collect())


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = ann.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(ann.hadamard(y), x)


def test_all_rows_are_returned_if_there_are_few(frame):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=8).astype(np.float32).tolist()) for i in range(15)]
    result = found(frame, rows, k=20, dim=8, tables=2, probes=1)
    expected = plain(rows, 20)
    assert [r[:3] for r in result] == [e[:3] for e in expected]
    assert np.allclose([r[3] for r in result], [e[3] for e in expected])


def test_copies_ties_and_unusable_rows(frame):
    random = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.0, 0.0]) for i in range(60)]
    rows += [(i, random.integers(-2, 3, 4).astype(float).tolist()) for i in range(60, 120)]
    rows += [(0, [1.0, 2.0, 0.0, 0.0])]  # a repeated row
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0])]
    rows += [(260, [float("nan"), 1.0, 0.0, 0.0]), (280, [float("inf")] * 4)]
    rows += [(300, [1.0, 2.0]), (None, [1.0, 2.0, 0.0, 0.0])]
    rows = [(i, v) for i, v in rows if v is None or len(v) == 4] + [(300, [1.0, 2.0])]
    result = found(frame, rows, k=7, dim=4, tables=8, probes=8)
    expected = plain([r for r in rows if r[1] is None or len(r[1]) == 4], 7)
    assert [r[:3] for r in result] == [e[:3] for e in expected]


def test_recall_on_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    expected = {(q, i) for q, _, i, _ in plain(rows, 20)}
    result = ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect()
    hits = sum((r.query_id, r.vec_id) in expected for r in result)
    assert hits >= 0.9 * len(expected)


def test_blocks_do_not_change_the_result(frame, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    whole = found(frame, rows, k=5, dim=8)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    assert found(frame, rows, k=5, dim=8) == whole


def test_empty_table(frame):
    assert found(frame, []) == []
