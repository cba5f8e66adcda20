"""Language identification from character n-grams.

Features are hashed n-grams of one to three characters of the lower-cased text, with every run
of non-letters as one space, weighted by (1 + log count) times inverse document frequency and
scaled to length one. Document frequencies are counted over all labelled documents. The
classifier is a sparse multinomial logistic regression, trained with follow-the-regularised-
leader (FTRL-proximal) under an elastic-net penalty on at most ``per_language`` documents of
each language, taken by a hash of their id (of rows with one id and label, the least text);
every fifth of them is kept apart to fit the
temperature that calibrates the probabilities. Features are bounded by ``FEATURES`` per
document, so the sample that reaches the driver is bounded whatever the texts.

Cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if no
document is labelled; a null label is not learned from; ties between languages go to the
first in code point order; repeated rows are predicted alike; an empty table gives an empty
result; further columns are ignored by ``predict`` and kept by ``recognised``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.sampling import bounded_sample
from basketry.llm.scratch import stored

#: Hashed n-grams; one more place is the constant.
FEATURES = 1 << 15
_NONE = np.uint32(FEATURES)
LONGEST = 3

#: Text whose features are counted at once; several numbers per character are held.
_TEXT_BYTES = 1 << 20

_FACTORS = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F]

#: Characters that count as they are: the ASCII letters and all beyond ASCII.
_KEPT = np.zeros(128, dtype=bool)
_KEPT[ord("a") : ord("z") + 1] = True


@dataclass(frozen=True)
class Counts:
    """Distinct features and their counts, text by text."""

    feature: np.ndarray
    count: np.ndarray
    places: np.ndarray
    lettered: np.ndarray


def count_features(data: np.ndarray, offsets: np.ndarray) -> Counts:
    raw, ends = data.tobytes(), offsets.tolist()
    texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(ends, ends[1:], strict=False)]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, dtype=np.uint32)
    ascii_code = codes < 128
    letter = ~ascii_code
    letter[ascii_code] = _KEPT[codes[ascii_code]]
    doc = np.repeat(np.arange(len(texts)), sizes)
    lettered = np.bincount(doc[letter & ascii_code], minlength=len(texts)) > 0
    for i in np.flatnonzero(~lettered).tolist():
        lettered[i] = any(c.isalpha() for c in texts[i])
    kept = letter.copy()
    if len(kept):
        kept[0] = True
        kept[1:] |= letter[:-1]
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        kept[begin[sizes > 0]] = True
    codes, doc = np.where(letter, codes, np.uint32(0))[kept], doc[kept]
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    left = first[1:][doc] - np.arange(len(doc)) if len(doc) else doc
    grams = np.full((len(codes), LONGEST), _NONE, dtype=np.uint32)
    sums = np.zeros(len(codes), dtype=np.uint32)
    for n in range(LONGEST):
        sums[: len(codes) - n] += codes[n:] * np.uint32(_FACTORS[n])
        h = sums + np.uint32(n + 1) * np.uint32(_FACTORS[-1])
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        own = (h & np.uint32(FEATURES - 1)).astype(np.uint32)
        grams[:, n] = np.where(left > n, own, _NONE)
    flat = grams.reshape(-1)
    bounds = (first * LONGEST).tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        flat[a:b].sort()
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    starts = np.array(bounds[:-1], dtype=np.int64)
    new[starts[starts < len(flat)]] = True
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(flat)))
    feature = flat[at]
    real = feature != _NONE
    at, feature, count = at[real], feature[real], count[real]
    return Counts(feature, count, np.searchsorted(at, np.array(bounds)), lettered)


def _sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[places[1:]] - total[places[:-1]]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # features and the constant x languages
    idf: np.ndarray
    temperature: float

    def logits(self, counts: Counts) -> np.ndarray:
        value = (1 + np.log(counts.count)) * self.idf[counts.feature]
        norm = np.sqrt(np.maximum(_sums(value**2, counts.places), 1e-12))
        out = np.empty((len(norm), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = _sums(value * self.weights[counts.feature, k], counts.places) / norm
        return (out + self.weights[FEATURES]) / self.temperature


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: int,
    epochs: int = 4,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
    seed: int = 3,
) -> np.ndarray:
    """Weights (features and the constant x classes); ``rows`` are (features, values)."""
    z = np.zeros((FEATURES + 1, classes))
    n = np.zeros((FEATURES + 1, classes))
    order = np.random.default_rng(seed)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            feature, value = rows[i]
            w = weights(z[feature], n[feature])
            p = softmax((value @ w)[None])[0]
            p[labels[i]] -= 1
            g = value[:, None] * p
            grown = n[feature] + g * g
            z[feature] += g - (np.sqrt(grown) - np.sqrt(n[feature])) / alpha * w
            n[feature] = grown
    return weights(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature in [0.05, 20] with the least log loss, by golden section.

    As many rows could not show an error rate below 1 / (rows + 2), so that much of each
    target goes to the other classes; else rows that are all right would drive it to 0.
    """
    doubt = 1 / (len(labels) + 2)
    target = np.full(logits.shape, doubt / max(logits.shape[1] - 1, 1))
    target[np.arange(len(labels)), labels] = 1 - doubt

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-300))).sum())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def _document_frequencies(labelled: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, dtype=np.int64)
        for _, data, offsets in words.blocks(batches, limit=_TEXT_BYTES):
            found = count_features(data, offsets)
            total += np.bincount(found.feature, minlength=FEATURES + 1)
            total[FEATURES] += len(offsets) - 1  # the documents themselves
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "n"])

    rows = labelled.select("text").mapInArrow(count, "feature long, n long")
    table = rows.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # a row per feature
    total = np.zeros(FEATURES + 1, dtype=np.int64)
    total[table["feature"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return total[:FEATURES], int(total[FEATURES])


def _sample(labelled: DataFrame, per_language: int) -> pd.DataFrame:
    """Label, features and counts of the documents to learn from."""
    light = labelled.select("doc_id", "lang").distinct()
    chosen = stored(bounded_sample(light, "lang", per_language, "doc_id"), "sample")
    # At most ``per_language`` rows for each language.
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "lang"])
    # An id may stand on any number of rows.
    texts = texts.groupBy("turn", "lang").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches, limit=_TEXT_BYTES):
            found = count_features(data, offsets)
            lists = [
                pa.LargeListArray.from_arrays(pa.array(found.places), pa.array(x.astype(np.int32))).cast(pa.list_(pa.int32()))
                for x in (found.feature, found.count)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists], ["turn", "lang", "feature", "n"]
            )

    rows = texts.mapInArrow(features, "turn int, lang string, feature array<int>, n array<int>")
    return rows.toPandas().sort_values(["lang", "turn"], ignore_index=True)


def train(labelled: DataFrame, per_language: int = 500) -> Model | None:
    """A model from doc_id, lang (not null) and text; None if there are no rows."""
    frequency, documents = _document_frequencies(labelled)
    if not documents:
        return None
    idf = np.log((1 + documents) / (1 + frequency)) + 1
    sample = _sample(labelled, per_language)
    languages = sorted(sample["lang"].unique(), key=lambda x: x.encode())
    labels = sample["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy()
    rows = []
    for feature, n in zip(sample["feature"], sample["n"], strict=True):
        value = (1 + np.log(np.asarray(n, dtype=np.float64))) * idf[feature]
        norm = np.sqrt((value**2).sum()) or 1.0
        rows.append((np.append(feature, FEATURES).astype(np.int64), np.append(value / norm, 1.0)))
    apart = (sample["turn"] % 5 == 0).to_numpy()
    fitting = np.flatnonzero(~apart)
    weights = train_ftrl([rows[i] for i in fitting], labels[fitting], len(languages))
    if apart.any():
        logits = np.stack([rows[i][1] @ weights[rows[i][0]] for i in np.flatnonzero(apart)])
        temperature = fit_temperature(logits, labels[apart])
    else:
        temperature = 1.0
    return Model(languages, weights, idf, temperature)


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, from the text alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = f"{rows.drop('__text').schema.toDDL()}, lang_pred string, score double"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, data, offsets in words.blocks(batches, "__text", _TEXT_BYTES):
            texts = len(offsets) - 1
            names, score = np.full(texts, "und", dtype=object), np.zeros(texts)
            if model is not None:
                found = count_features(data, offsets)
                p = softmax(model.logits(found))
                best = p.argmax(axis=1)
                named = np.array(model.languages, dtype=object)[best]
                names = np.where(found.lettered, named, names)
                score = np.where(found.lettered, p[np.arange(texts), best], 0.0)
            kept = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names.tolist(), pa.string()), pa.array(score)],
                [n for n in batch.schema.names if n != "__text"] + ["lang_pred", "score"],
            )

    return rows.mapInArrow(assign, schema)


def labelled_rows(docs: DataFrame, learn: Column) -> DataFrame:
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.select("doc_id", "lang", "text")


def recognised(docs: DataFrame, least_score: float, per_language: int = 500) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least ``least_score``."""
    model = train(labelled_rows(docs, F.lit(True)), per_language)
    boxed = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    rows = predict(boxed, model, "__row")
    good = (F.col("lang_pred") != "und") & (F.col("score") >= least_score)
    return rows.where(good).select("__row.*")
