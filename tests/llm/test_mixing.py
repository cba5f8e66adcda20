import re

import pytest

from basketry.llm import mixing


def plain_targets(sizes, weights, share, epochs):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = total / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: epochs * sizes[s] for s in over}
        total -= sum(epochs * sizes[s] for s in over)
        free -= over
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (1, 100)])
def test_targets_and_taken_words(docs, weights):
    rows = [
        (i, f"\tword{i} " * (1 + i * 7 % 40) + "\n", "en", [None, "B", "a", "ä", "z9"][i % 5 if i % 3 else 0], 0)
        for i in range(400)
    ]
    result = mixing.plan(docs(rows), weights).collect()
    sizes = {}
    for r in result:
        assert r["size"] == size_of(r.text) and 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    expected = plain_targets(sizes, weights, 1.5, 2.0)
    for source, target in expected.items():
        own = [r for r in result if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in own) - target) <= 1 + len(own) / 100
    again = mixing.plan(docs(rows).repartition(7), weights).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in result)


def test_odd_rows(docs):
    result = mixing.plan(docs()).collect()
    assert sorted(r["size"] for r in result) == sorted(size_of(r.text) for r in docs().collect())
    assert all(r.taken == 0 for r in result if not r["size"])
    assert mixing.plan(docs([])).collect() == []
    empty = mixing.plan(docs([(1, None, "en", "a", 0), (2, "", "en", None, 0)])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2


def test_the_mixture_holds_the_words_taken(docs):
    rows = [(i, f" a{i} b{i}\nc " * (1 + i % 5), "en", "st"[i % 2], 0) for i in range(60)]
    planned = {r.doc_id: r for r in mixing.plan(docs(rows)).collect()}
    mixture = mixing.mixed(docs(rows))
    assert mixture.columns == docs().columns
    words, texts = {}, {i: t for i, t, *_ in rows}
    for r in mixture.collect():
        assert texts[r.doc_id].startswith(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + size_of(r.text)
    assert words == {i: r.taken for i, r in planned.items() if r.taken}
    assert mixing.mixed(docs()).count() >= 0


def test_one_document_of_a_source_is_cut_at_most(docs):
    rows = [(i if i % 9 else None, f"word{i} " * (20 + i * 7 % 40), "en", "st"[i % 7 == 0], 0) for i in range(9000)]
    result = mixing.plan(docs(rows), weights=(1, 5)).collect()
    for source in "st":
        own = [r for r in result if r.source == source]
        cut = [r for r in own if (r.taken - r.epochs * r["size"]) not in (0, r["size"])]
        assert len(cut) <= 1 and abs(sum(r.taken for r in own) - own[0].target) <= 1
