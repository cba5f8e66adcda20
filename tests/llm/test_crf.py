import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketry.llm import crf, words


def test_lines_and_their_lengths():
    texts = ["a b\n\nc", "", "x\n", "\n", None, "one", "A A A\nA A A"]
    bins, length, first = crf.line_features(*words.text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, first, first[1:], strict=False):
        assert length[a:b].tolist() == [len(x) for x in (text or "").split("\n")]
    elsewhere = bins[:, list(crf.RANGES).index("elsewhere")]
    assert elsewhere.tolist() == [0] * 10 + [1, 1]


def test_marginals_sum_all_labelings():
    random = np.random.default_rng(0)
    lines = [1, 4, 2, 5]
    first = np.concatenate([[0], np.cumsum(lines)])
    score, same = random.normal(size=first[-1]), 0.7
    forward, backward = crf.messages(score, first, same)
    for a, b in zip(first, first[1:], strict=False):
        weight = np.zeros(b - a)
        total = 0.0
        for labels in itertools.product((0, 1), repeat=b - a):
            p = np.exp(
                sum(s for s, y in zip(score[a:b], labels, strict=True) if y)
                + same * sum(x == y for x, y in itertools.pairwise(labels))
            )
            total += p
            weight += p * np.array(labels)
        assert np.allclose(crf._sigmoid(forward + backward)[a:b], weight / total)


def test_held_out_quality(spark, sf):
    folder = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    field = crf.train(docs, labels, F.col("doc_id") % 5 != 0)
    rows = crf.predict(docs, field, "doc_id").join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad).mean() > 0.95
    assert (good >= 0.3).mean() > 0.95


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame(
        [(4, 0), (5, 1), (5, 1), (8, 0), (9, 1), (9, 0), (None, 1), (6, None)],
        "doc_id long, quality int",
    )
    field = crf.train(docs(), labels, F.lit(True))
    result = crf.predict(docs(), field, "doc_id").collect()
    assert len(result) == docs().count() and all(0 <= r.score <= 1 for r in result)
    assert crf.predict(docs([]), field, "doc_id").collect() == []
    assert crf.train(docs(), labels.where("false"), F.lit(True)) is None
    assert {r.score for r in crf.predict(docs(), None, "doc_id").collect()} == {0.5}
