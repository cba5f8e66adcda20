"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. Its own features and those of the lines before and
after it (length, words, shares of kinds of characters, words repeated at once, whether the
line stands elsewhere in the text, its place) are cut into ranges and each range has a
weight; one more weight rewards neighbouring lines of the same label. The forward-backward
recursion gives the probability that a line is good, and a document's quality is the mean
of these over its lines, weighted by length, and brought to the scale of a probability by a
logistic curve fitted to the labels. With two labels a message is one number, the
log odds, and all documents of a block advance together, line by line.

The field is trained on at most ``per_label`` documents of each label, taken whole by a hash
of their id, every line with its document's label; a line's features are a few bytes.

Cases: a null or empty text is one empty line; repeated rows are scored alike; documents
labelled both ways are not learned from; without any label every score is 0.5; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.sampling import bounded_sample
from basketry.llm.scratch import stored

_SHARES = [0.0, 0.01, 0.03, 0.08, 0.15, 0.3, 0.6]
_SIZES = [0, 8, 32, 128, 512, 2048, 8192]
#: Upper ends of the ranges of each feature; a range more is above, one more is "no line".
RANGES = {
    "length": _SIZES,
    "words": [0, 1, 4, 16, 64, 256, 1024],
    "word_length": [0, 2, 3, 4, 5, 7, 10],
    "letters": [0.0, 0.3, 0.5, 0.65, 0.75, 0.85, 0.95],
    "capitals": _SHARES,
    "digits": _SHARES,
    "symbols": _SHARES,
    "exclamations": _SHARES,
    "other_marks": _SHARES,
    "repeated_words": _SHARES,
    "elsewhere": [0],
    "place": [0, 1, 2],
}
BINS = 9
_ABSENT = BINS - 1
WIDTH = len(RANGES) * BINS


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(members)] = 1
    return table


_CAPITALS = bytes(range(65, 91))
_KINDS = {
    "letters": _table(_CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))),
    "capitals": _table(_CAPITALS),
    "digits": _table(b"0123456789"),
    "symbols": _table(b"#*$%&|<>"),
    "exclamations": _table(b"!"),
    "other_marks": _table(b"\"'(),-./:;=?@[\\]^_`{}~+"),
}


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges (lines x features) and lengths of all lines, and the first line of each text."""
    texts = len(offsets) - 1
    breaks = np.flatnonzero(data == 10) + 1
    # Each text begins a line, and so does what follows a line feed inside it.
    start = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
    owner = np.searchsorted(breaks, offsets[:-1], side="right") + np.arange(texts)
    # A line feed at the very end of a text opens an empty line that belongs to this text.
    first = np.append(owner, len(start))
    end = np.append(start[1:], len(data))
    n = end - start
    closed = np.zeros(len(n), dtype=bool)
    nonempty = np.flatnonzero(n > 0)
    closed[nonempty] = data[end[nonempty] - 1] == 10
    length = n - closed
    ends = start + length
    bounds = np.append(start, len(data)).astype(np.int64)
    values: dict[str, np.ndarray] = {"length": length}
    line_starts, line_ends, first_word = words.spans(data, bounds)
    count = np.diff(first_word)
    of_line = np.repeat(np.arange(len(n)), count)
    values["words"] = count
    size = np.bincount(of_line, weights=line_ends - line_starts, minlength=len(n))
    values["word_length"] = size / np.maximum(count, 1)
    safe = np.maximum(length, 1)
    for name, table in _KINDS.items():
        if len(data):
            # reduceat has no empty runs, so only lines with bytes are summed.
            total = np.zeros(len(n), dtype=np.int64)
            total[nonempty] = np.add.reduceat(table[data], start[nonempty], dtype=np.int32)
        else:
            total = np.zeros(len(n), dtype=np.int64)
        values[name] = total / safe
    values["capitals"] = values["capitals"] / np.maximum(values["letters"], 1e-9)
    word = words.hashes(data, line_starts, line_ends)
    again = np.zeros(len(word), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (of_line[1:] == of_line[:-1])
    values["repeated_words"] = np.bincount(of_line[again], minlength=len(n)) / np.maximum(count, 1)
    doc = np.repeat(np.arange(texts), np.diff(first))
    same = np.zeros(len(n), dtype=np.uint64)
    whole = np.flatnonzero(length > 0)
    same[whole] = words.hashes(data, start[whole], ends[whole])
    key = words.mix(same ^ words.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    values["elsewhere"] = (times[inverse] > 1) & (length > 0)
    lines = np.diff(first)
    place = np.full(len(n), 1)
    place[first[:-1]] = 0
    place[first[1:] - 1] = np.where(lines > 1, 2, 3)
    values["place"] = place
    bins = np.empty((len(n), len(RANGES)), dtype=np.uint8)
    for k, (name, cuts) in enumerate(RANGES.items()):
        bins[:, k] = np.searchsorted(np.array(cuts), values[name], side="left")
    return bins, length, first


def indices(bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of the weights that are on for each line: before, own, after x features."""
    base = (np.arange(len(RANGES)) * BINS).astype(np.int32)
    own = bins + base
    absent = np.full((1, len(RANGES)), _ABSENT, dtype=np.int32) + base
    before = np.concatenate([absent, own[:-1]])
    after = np.concatenate([own[1:], absent])
    before[first[:-1]] = absent
    after[first[1:] - 1] = absent
    return np.concatenate([before, own + WIDTH, after + 2 * WIDTH], axis=1)


def _pass_on(odds: np.ndarray, same: float) -> np.ndarray:
    """Log odds that a line sends to its neighbour."""
    return np.logaddexp(odds + same, 0) - np.logaddexp(odds, same)


def messages(score: np.ndarray, first: np.ndarray, same: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward (with a line's own score) and backward log odds of every line."""
    lines = np.diff(first)
    order = np.argsort(-lines, kind="stable")
    sorted_lines = -lines[order]
    head, tail = first[:-1][order], first[1:][order] - 1
    forward, backward = score.copy(), np.zeros_like(score)
    for step in range(1, int(lines.max()) if len(lines) else 0):
        active = int(np.searchsorted(sorted_lines, -step))
        at = head[:active] + step
        forward[at] += _pass_on(forward[at - 1], same)
        at = tail[:active] - step
        backward[at] = _pass_on(score[at + 1] + backward[at + 1], same)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def fit_curve(odds: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (not negative) and height of a logistic curve, by Newton's method.

    Targets are drawn in by one row of each label, so that labels which the odds separate
    completely do not make the curve a step.
    """
    good = label.sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (len(label) - good + 2))
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(x @ theta)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (target - p) - 1e-3 * theta)
        theta = theta + step / max(1.0, np.abs(step).max())
    return max(float(theta[0]), 0.0), float(theta[1])


@dataclass(frozen=True)
class Field:
    weights: np.ndarray
    bias: float
    same: float
    #: Slope and height of the curve from the log odds of the mean to those of the score.
    slope: float = 1.0
    height: float = 0.0

    def scores(self, bins: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Quality of each text, higher the likelier its label is good."""
        return _sigmoid(self.slope * _log_odds(self.means(bins, length, first)) + self.height)

    def means(self, bins: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean of the probabilities of each text's lines, weighted by length."""
        score = self.weights[indices(bins, first)].sum(axis=1) + self.bias
        forward, backward = messages(score, first, self.same)
        weight = length + 1.0
        total = np.concatenate([[0], np.cumsum(_sigmoid(forward + backward) * weight)])
        scale = np.concatenate([[0], np.cumsum(weight)])
        mean = (total[first[1:]] - total[first[:-1]]) / (scale[first[1:]] - scale[first[:-1]])
        return np.clip(mean, 0.0, 1.0)


def train_field(
    bins: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 120, rate: float = 0.1, l2: float = 1e-3
) -> Field:
    """Maximum conditional likelihood of the line labels under an L2 penalty, by Adam."""
    on = indices(bins, first)
    lines = np.diff(first)
    y = np.repeat(label, lines).astype(np.float64)
    inner = np.ones(len(y), dtype=bool)
    inner[first[1:] - 1] = False  # lines with a next line in the same text
    left = np.flatnonzero(inner)
    theta = np.zeros(3 * WIDTH + 2)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    # Each text counts alike, whatever its number of lines.
    weight = np.repeat(1 / lines, lines)
    for step in range(1, rounds + 1):
        weights, bias, same = theta[:-2], theta[-2], theta[-1]
        score = weights[on].sum(axis=1) + bias
        forward, backward = messages(score, first, same)
        off = (y - _sigmoid(forward + backward)) * weight
        grad = np.zeros_like(theta)
        for column in on.T:
            grad[:-2] += np.bincount(column, weights=off, minlength=3 * WIDTH)
        grad[-2] = off.sum()
        # Odds that two neighbours agree: both good or both bad against one of each.
        a, b = forward[left], score[left + 1] + backward[left + 1]
        agree = _sigmoid(same + np.logaddexp(a + b, 0) - np.logaddexp(a, b))
        grad[-1] = ((y[left] == y[left + 1]) - agree) @ weight[left]
        grad = grad / len(lines) - l2 * theta
        mean = 0.9 * mean + 0.1 * grad
        spread = 0.999 * spread + 0.001 * grad**2
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        theta[-1] = max(theta[-1], 0.0)
    return Field(theta[:-2], float(theta[-2]), float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = 1500) -> Field | None:
    """A field from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) where ``learn``."""
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    known = known.where(F.col("quality") == F.col("most")).drop("most")
    # At most 2 x per_label rows.
    chosen = bounded_sample(known, "quality", per_label, "doc_id")
    chosen = stored(chosen.select("doc_id", "quality"), "sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            bins, length, first = line_features(data, offsets)
            raw = bins.tobytes()
            places = (first * len(RANGES)).tolist()
            packed = [raw[a:b] for a, b in zip(places, places[1:], strict=False)]
            sizes = length.astype("<i8").tobytes()
            lengths = [sizes[8 * a : 8 * b] for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(packed, pa.binary()),
                    pa.array(lengths, pa.binary()),
                ],
                ["doc_id", "quality", "bins", "lengths"],
            )

    rows = texts.select("doc_id", "quality", "text").mapInArrow(
        features, "doc_id long, quality int, bins binary, lengths binary"
    )
    sample = rows.toPandas().sort_values(["doc_id", "bins"], ignore_index=True)
    if not len(sample):
        return None
    parts = [np.frombuffer(b, dtype=np.uint8).reshape(-1, len(RANGES)) for b in sample["bins"]]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    bins, label = np.concatenate(parts), sample["quality"].to_numpy()
    field = train_field(bins, first, label)
    length = np.frombuffer(b"".join(sample["lengths"]), dtype="<i8")
    slope, height = fit_curve(_log_odds(field.means(bins, length, first)), label)
    return replace(field, slope=slope, height=height)


def predict(docs: DataFrame, field: Field | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the score of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = f"{rows.drop('__text').schema.toDDL()}, score double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch, data, offsets in words.blocks(batches, "__text"):
            score = np.full(len(offsets) - 1, 0.5)
            if field is not None:
                score = field.scores(*line_features(data, offsets))
            kept = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], [*names, "score"])

    return rows.mapInArrow(assign, schema)
