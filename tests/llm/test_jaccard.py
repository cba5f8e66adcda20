from fractions import Fraction

import numpy as np
import pytest

from basketry.llm import jaccard


def plain_sets(rows, width):
    out = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
        out.append((doc_id, grams or ({tuple(w)} if w else set())))
    return out


def plain_components(rows, width, t):
    sets = [(i, s) for i, s in plain_sets(rows, width) if i is not None]
    label = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, s in sets:
            for j, other in sets:
                if s and other and len(s & other) >= t * len(s | other) and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


def found(frame, width, threshold):
    return {r.doc_id: r for r in jaccard.near_duplicates(frame, width, threshold).collect()}


def varied(random, base, changes):
    words = base.split()
    for _ in range(changes):
        words[int(random.integers(len(words)))] = f"new{random.integers(10_000)}"
    return " ".join(words)


@pytest.mark.parametrize(("threshold", "frequent"), [("0.8", 64), ("0.9", 64), ("0.8", 3), ("0.6", 2)])
def test_components_equal_all_pairs(docs, monkeypatch, threshold, frequent):
    """With few frequent places allowed, most keys are pairs of frequent shingles."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "KEY_BLOCK", 4)
    random = np.random.default_rng(frequent)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(random.choice(vocabulary, 60))
    rows = []
    for family in range(6):
        base = " ".join(random.choice(vocabulary, int(random.integers(20, 300))))
        base = base + " " + passage if family % 2 else base
        for k in range(8):
            rows.append((len(rows) + 1, varied(random, base, k * family // 2), "en", "s", 0))
    rows += [(100 + k, f"lone text {k} " + passage, "en", "s", 0) for k in range(10)]
    rows += [(200, passage.upper(), "en", "s", 0), (201, "two words", "en", "s", 0)]
    rows += [(202, "Two  words", "en", "s", 0), (203, None, "en", "s", 0), (204, " ", "en", "s", 0)]
    result = found(docs(rows), 3, threshold)
    expected = plain_components(rows, 3, Fraction(threshold))
    assert {i: r.component_id for i, r in result.items()} == expected
    sizes = {i: len(s) for i, s in plain_sets(rows, 3)}
    assert {i: r.n_shingles for i, r in result.items()} == sizes


def test_similar_sets_share_a_key():
    random = np.random.default_rng(9)
    t = Fraction(9, 10)
    shared = 0
    for _ in range(400):
        n = int(random.integers(1, 400))
        x = np.unique(random.integers(0, 2**60, n).astype(np.uint64))
        y = x[random.random(len(x)) > random.random() * 0.12]
        y = np.unique(np.append(y, random.integers(0, 2**60, int(len(x) * 0.03)).astype(np.uint64)))
        common = len(np.intersect1d(x, y))
        if not len(y) or common < t * len(np.union1d(x, y)):
            continue
        is_frequent = np.vectorize(lambda v, p=random.random(): hash(int(v)) % 997 < 997 * p)
        keys = [np.concatenate(jaccard.keys_of(v, is_frequent(v), t)) for v in (x, y)]
        assert len(np.intersect1d(*keys))
        bitmaps = [jaccard._bitmap(v) for v in (x, y)]
        assert jaccard._distance(*bitmaps) <= len(x) + len(y) - 2 * common
        shared += 1
    assert shared > 100


def test_odd_rows(docs):
    result = jaccard.near_duplicates(docs()).collect()
    assert len(result) == docs().count()
    by_id = {r.doc_id: r for r in result}
    assert by_id[6].component_id == by_id[5].component_id == 5
    assert by_id[1].n_shingles == 0 and by_id[1].component_id == 1
    assert by_id[None].component_id is None
    assert jaccard.near_duplicates(docs([])).collect() == []


def test_one_row_of_each_group_stays(docs):
    kept = jaccard.distinct_documents(docs())
    assert kept.columns == docs().columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8, 9]
    assert ids.count(None) == 2


def test_texts_of_one_id_are_compared_each_on_its_own(docs):
    """Neither is a link lost, nor an unlike text dropped."""
    random = np.random.default_rng(4)
    one, two, three = (" ".join(random.choice([f"v{k}" for k in range(900)], 120)) for _ in range(3))
    rows = [(1, one), (7, two), (7, varied(random, one, 1)), (8, varied(random, two, 1)), (9, three), (9, three)]
    frame = docs([(i, text, "en", "s", 0) for i, text in rows])
    result = jaccard.near_duplicates(frame).collect()
    assert sorted((r.doc_id, r.component_id) for r in result) == [(1, 1), (7, 1), (7, 7), (8, 7), (9, 9), (9, 9)]
    kept = {(r.doc_id, r.text) for r in jaccard.distinct_documents(frame).collect()}
    assert kept == {(1, one), (7, two), (9, three)}


def test_a_common_template_makes_no_pairs(spark, docs, monkeypatch):
    """Texts with four fifths in common and the rest their own are never similar, and none of
    their pairs is looked at; near copies among them are still found."""
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    random = np.random.default_rng(5)
    template = [f"t{k}" for k in range(160)]
    rows = [(k + 1, " ".join([*template, *(f"o{k}x{j}" for j in range(35))]), "en", "s", 0) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " end", "en", "s", 0) for k in range(5)]
    t, width = Fraction("0.8"), 5
    texts = jaccard._texts(docs(rows))
    frequent = jaccard.frequent_shingles(texts, width, 3)
    shared = jaccard.shared_keys(jaccard.postings(texts, width, t, frequent))
    assert shared.where("often").isEmpty()
    result = found(docs(rows), width, "0.8")
    assert {i: r.component_id for i, r in result.items()} == plain_components(rows, width, t)


def test_further_columns_with_clashing_names(docs):
    names = ["key", "component_id", "class_id", "n_shingles", "text_hash", "__row", "first"]
    frame = docs()
    wide = frame.selectExpr("*", *(f"doc_id AS {n}" for n in names))
    plain_rows = sorted(map(str, jaccard.near_duplicates(frame).collect()))
    assert sorted(map(str, jaccard.near_duplicates(wide).collect())) == plain_rows
    kept = jaccard.distinct_documents(wide)
    assert kept.columns == wide.columns
    assert kept.count() == jaccard.distinct_documents(frame).count()


def test_rows_of_a_rare_key_need_a_partner_of_fitting_size():
    """Kept are rows with another of the key one step away at most, wherever they stand."""
    random = np.random.default_rng(5)
    key = np.sort(random.integers(0, 60, 300))
    step = random.integers(0, 30, 300).astype(np.int32)
    expected = [
        any(i != j and key[i] == key[j] and abs(int(step[i]) - int(step[j])) <= 1 for j in range(300))
        for i in range(300)
    ]
    assert jaccard._with_partner(key, step).tolist() == expected
    assert jaccard._with_partner(key[:0], step[:0]).tolist() == []
