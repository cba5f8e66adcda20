"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import ODD_ROWS
from pyspark.sql import functions as F

from basketry.llm import ranking


def terms(text):
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, items, k):
    listed = [(row[0], Counter(terms(row[1]))) for row in rows]
    listed = [(doc, counts, sum(counts.values())) for doc, counts in listed if counts]
    n, total = len(listed), sum(size for _, _, size in listed)
    df = Counter(term for _, counts, _ in listed for term in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, counts, size in listed:
            m = 100 - 50 + (50 * size * n) // total
            score = 0
            for term in wanted & counts.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                score += weight * ((1000000000 * counts[term]) // (1000 * counts[term] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=str)


def found(docs, items, k):
    result = ranking.search(docs, items, k)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(row) for row in result.collect()), key=str)


def texts(number, seed, vocabulary=40):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    shares = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(names, shares, k=rng.randint(0, 60))) for _ in range(number)]


@pytest.mark.parametrize(("k", "segment"), [(1, 7), (5, 1 << 14), (50, 30), (1000, 64)])
def test_equals_all_scores(spark, docs, monkeypatch, k, segment):
    monkeypatch.setattr(ranking, "SEGMENT_DOCUMENTS", segment)
    rows = [(i, text, "en", "a", 0) for i, text in enumerate(texts(300, seed=k))]
    items = list(enumerate(texts(12, seed=k + 1)))
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(docs(rows).repartition(3), asked, k) == plain(rows, items, k)


def test_ties_and_repeated_rows(spark, docs):
    rows = [(i % 40, "same words here", "en", "a", 0) for i in range(100)]
    rows += [(200 + i, f"other {i}", "en", "a", 0) for i in range(100)]
    items = [(1, "same words"), (2, "HERE, same"), (3, "nothing"), (4, None), (5, ""), (6, "other 7"), (6, "here")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(docs(rows), asked, 50) == plain(rows, items, 50)


def test_odd_rows(spark, docs):
    items = [(1, "The short text"), (None, "größe ÜBERMUT id"), (2, "word"), (3, "x" * 70_000), (4, "123")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(ODD_ROWS)
    for name in ("item_id", "rank", "score", "terms", "ids"):
        frame, asked = frame.withColumn(name, F.lit("clash")), asked if name == "item_id" else asked.withColumn(name, F.lit(1))
    assert found(frame, asked, 50) == plain(ODD_ROWS, items, 50)
    assert found(docs([]), asked, 50) == []
    assert found(frame, asked.limit(0), 50) == []


def test_more_queries_than_a_group(spark, docs, monkeypatch):
    monkeypatch.setattr(ranking, "QUERIES", 4)
    rows = [(i, text, "en", "a", 0) for i, text in enumerate(texts(60, seed=3))]
    items = list(enumerate(texts(10, seed=4)))
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(docs(rows), asked, 5) == plain(rows, items, 5)


def test_reading_stops_early():
    """With clear winners most of long lists is never read."""
    size = 10_000
    rng = np.random.default_rng(1)
    term = np.repeat([0, 1], size)
    docs = np.tile(np.arange(size), 2)
    impact = rng.integers(1, 50, 2 * size)
    impact[docs < 5] = 1000 + docs[docs < 5]
    lists = ranking.Lists.of(term, docs, impact, 2, size)
    seen = []
    original = np.bincount

    def counted(values, *rest):
        seen.append(len(values))
        return original(values, *rest)

    ranking.np.bincount = counted
    try:
        found_docs, scores = ranking.read_best(lists, np.array([0, 1]), 5, np.zeros(0, dtype=np.int64))
    finally:
        ranking.np.bincount = original
    assert sorted(found_docs.tolist()) == [0, 1, 2, 3, 4]
    assert sorted(scores.tolist()) == [2000, 2002, 2004, 2006, 2008]
    assert max(seen) < 100
