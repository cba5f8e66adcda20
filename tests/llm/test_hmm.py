import itertools
import math
import timeit
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import hmm


def random_model(seed, states=3, symbols=5):
    random = np.random.default_rng(seed)
    normal = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(
        normal(random.random(states), 0),
        normal(random.random((states, states)), 1),
        normal(random.random((symbols, states)), 0),
    )


def paths(model, classes):
    """(probability, states) of every path of states, the one before the first included."""
    for path in itertools.product(range(len(model.start)), repeat=len(classes) + 1):
        p = model.start[path[0]]
        for a, b, x in zip(path, path[1:], classes, strict=False):
            p *= model.steps[a, b] * model.emit[x, b]
        yield p, path


def test_likelihood_sums_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "SEGMENT", 2)
    model, random = random_model(1), np.random.default_rng(2)
    texts = [random.integers(0, 5, n) for n in (1, 2, 5, 3, 4)]
    places = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = hmm.log_likelihood(model, np.concatenate(texts), places)
    expected = [math.log(sum(p for p, _ in paths(model, t))) for t in texts]
    assert np.allclose(found, expected)


def test_expected_counts_sum_all_paths(monkeypatch):
    model, random = random_model(3), np.random.default_rng(4)
    texts = [random.integers(0, 5, n) for n in (1, 4, 5, 2)]
    places = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    expected = hmm.Expected(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5)))
    for t in texts:
        every = list(paths(model, t))
        total = sum(p for p, _ in every)
        for p, path in every:
            expected.start[path[0]] += p / total
            for a, b, x in zip(path, path[1:], t, strict=False):
                expected.steps[a, b] += p / total
                expected.emit[b, x] += p / total
    for segment in (2, 256):
        monkeypatch.setattr(hmm, "SEGMENT", segment)
        found = hmm.Expected(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5)))
        found.add(model, np.concatenate(texts), places)
        assert np.allclose(found.start, expected.start)
        assert np.allclose(found.steps, expected.steps)
        assert np.allclose(found.emit, expected.emit)


def test_long_texts_do_not_underflow():
    model = random_model(5)
    classes = np.random.default_rng(6).integers(0, 5, 50_000)
    found = hmm.log_likelihood(model, classes, np.array([0, 50_000]))
    state, total = model.start, 0.0
    for x in classes:
        state = (state @ model.steps) * model.emit[x]
        total += math.log(state.sum())
        state = state / state.sum()
    assert math.isclose(found[0], total, rel_tol=1e-9)


def test_expected_counts_of_long_texts_with_uneven_emissions():
    model, random = random_model(7, symbols=40), np.random.default_rng(8)
    emit = model.emit ** 30  # a symbol is all but impossible in most states
    model = hmm.Model(model.start, model.steps, emit / emit.sum(axis=0))
    lengths = (700, 1, 256, 257, 30)
    texts = [random.integers(0, 40, n) for n in lengths]
    expected = hmm.Expected(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 40)))
    for t in texts:
        forward, ahead = [model.start], [np.ones(3)]
        for x in t:
            state = (forward[-1] @ model.steps) * model.emit[x]
            forward.append(state / state.sum())
        for x in t[::-1]:
            state = model.steps @ (model.emit[x] * ahead[-1])
            ahead.append(state / state.sum())
        ahead.reverse()
        expected.start += forward[0] * ahead[0] / (forward[0] @ ahead[0])
        for k, x in enumerate(t):
            step = forward[k][:, None] * model.steps * (model.emit[x] * ahead[k + 1])
            expected.steps += step / step.sum()
            expected.emit[:, x] += step.sum(axis=0) / step.sum()
    found = hmm.Expected(np.zeros(3), np.zeros((3, 3)), np.zeros((3, 40)))
    found.add(model, np.concatenate(texts), np.concatenate([[0], np.cumsum(lengths)]))
    assert np.allclose(found.start, expected.start, rtol=1e-9)
    assert np.allclose(found.steps, expected.steps, rtol=1e-9)
    assert np.allclose(found.emit, expected.emit, rtol=1e-9, atol=1e-12)


def test_a_pass_costs_no_more_than_two_plain_ones_over_the_matrices():
    model = random_model(9, states=4, symbols=1000)
    places = np.arange(0, 200_001, 200)
    classes = np.random.default_rng(10).integers(0, 1000, 200_000)

    def plain():
        matrix = np.repeat(np.eye(4)[None], 1000, axis=0)
        for step in range(200):
            on = np.arange(1000)
            moved = (matrix[on].reshape(-1, 4) @ model.steps).reshape(-1, 4, 4)
            moved = moved * model.emit[classes[places[:-1] + step]][:, None, :]
            matrix[on] = moved / moved.sum(axis=(1, 2))[:, None, None]

    def whole():
        hmm.Expected(np.zeros(4), np.zeros((4, 4)), np.zeros((4, 1000))).add(model, classes, places)

    assert min(timeit.repeat(whole, number=1, repeat=5)) < 2 * min(timeit.repeat(plain, number=1, repeat=5))


def check_base(frame, result):
    rows = frame.collect()
    crc = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows if r.doc_id is not None}
    split = lambda text: [*(text or "").encode().lower().split(), None]
    counts = Counter(w for r in rows if crc.get(r.doc_id, 1) != 1 for w in split(r.text))
    total = sum(counts.values())
    smooth = total + 0.5 * (len(counts) + 1)
    key = lambda x: (str(x[0]), x[1], x[2])
    expected = [
        (r.doc_id, len(w), sum(counts[x] > 0 for x in w),
         sum(math.log10((counts[x] + 0.5) / smooth) for x in w))
        for r in rows for w in [split(r.text)]
    ]
    found = [(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in result]
    for mine, theirs in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert mine[:3] == theirs[:3] and math.isclose(mine[3], theirs[3], rel_tol=1e-9, abs_tol=1e-9)
    assert {r.train_tokens for r in result} <= {total}


def scored(frame):
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return hmm.scored(frame, remainder != 1, remainder == 1).collect()


def test_base_score_and_gain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    result = scored(docs)
    check_base(docs, result)
    held = [r for r in result if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(docs):
    result = scored(docs())
    check_base(docs(), result)
    assert all(math.isfinite(r.score) for r in result)
    assert scored(docs([])) == []
    check_base(docs([(None, "a b", "en", "a", 0)]), scored(docs([(None, "a b", "en", "a", 0)])))


def test_words_of_two_tokens_have_emissions_in_a_large_corpus(docs):
    # More than 3 * 131,072 tokens: the least count must not grow with them.
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 != 1][:8]
    held = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    texts = ["a b " * 25_000 + f"a {'left' if k < 2 else 'c'} b " + "c d " * 25_000 + f"d {'right' if k < 2 else 'e'} c" for k in range(8)]
    texts += ["a b a left b a b a", "a b a right b a b a"]
    rows = [(i, t, "en", "a", 0) for i, t in zip(ids + held, texts, strict=True)]
    one, two = (r for r in scored(docs(rows)) if r.held_out)
    assert one.train_tokens > 3 << 17 and math.isclose(one.base_score, two.base_score)
    assert not math.isclose(one.score, two.score, rel_tol=1e-6)


def test_scores_equal_training_on_one_table(spark, docs, monkeypatch):
    """All chunks and ranges together give what one table of all words gives."""
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(hmm, "RANGE_BYTES", 1_000)
    random = np.random.default_rng(7)
    bodies = [" ".join(f"w{x}" for x in random.zipf(1.4, random.integers(1, 200)) if x < 500) for _ in range(60)]
    rows = [(i, text, "en", "a", 0) for i, text in enumerate(bodies)]
    found = {r.doc_id: r for r in scored(docs(rows).repartition(3))}
    learn = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i in found}
    tokens = [[w.encode() for w in b.split()] + [None] for b in bodies]
    counts = Counter(w for i, t in enumerate(tokens) if learn[i] for w in t)
    listed = sorted((w for w in counts if counts[w] >= 2), key=str)
    place = {w: k for k, w in enumerate(listed)}
    joined = b" ".join(w or b"x" for w in listed)
    data = np.frombuffer(joined, dtype=np.uint8)
    starts, ends, _ = hmm.words.spans(data, np.array([0, len(data)]))
    hashes = hmm.words.hashes(data, starts, ends)
    hashes[[k for k, w in enumerate(listed) if w is None]] = hmm.END
    total = sum(counts.values())
    rest = total - sum(counts[w] for w in listed) + 0.5 * (len(counts) - len(listed)) + 0.5
    frequency = np.array([*(counts[w] for w in listed), rest]) / (sum(counts[w] for w in listed) + rest)
    emit = frequency[:, None] * hmm.disturbed(np.append(hashes, hmm._REST), 4)
    steps = np.full((4, 4), 0.25) + np.eye(4)
    model = hmm.Model(np.full(4, 0.25), steps / steps.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def classes(kept):
        flat = [place.get(w, len(listed)) for i in kept for w in tokens[i]]
        return np.array(flat), np.concatenate([[0], np.cumsum([len(tokens[i]) for i in kept])])

    for _ in range(4):
        expected = hmm.Expected(np.zeros(4), np.zeros((4, 4)), np.zeros((4, len(frequency))))
        expected.add(model, *classes([i for i in learn if learn[i]]))
        steps, emit = expected.steps + 0.5, expected.emit.T + 50.0 * frequency[:, None]
        model = hmm.Model(
            (expected.start + 0.5) / (expected.start + 0.5).sum(),
            steps / steps.sum(axis=1, keepdims=True),
            emit / emit.sum(axis=0),
        )
    plain = hmm.log_likelihood(model, *classes(range(60))) / math.log(10)
    for i, score in enumerate(plain):
        share = sum(math.log10((counts[w] + 0.5) / rest) for w in tokens[i] if w not in place)
        assert math.isclose(found[i].score, score + share, rel_tol=1e-5)
