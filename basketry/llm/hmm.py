"""Hidden Markov language model: word counts, Baum-Welch and exact sequence likelihood.

Tokens are the words of a text, A-Z in lower case, and one end. Words with at least ``LEAST``
training tokens have emission probabilities of their own in every latent state, whatever the
size of the corpus. All other words are one symbol of the model, times the word's smoothed
share among them; so the model is a distribution over all V + 1 words.

1. ``encode`` turns blocks of text into a list of distinct words (as 64-bit hashes) with
   training counts, and the texts as places in that list.
2. ``count`` deals those lists by ranges of hashes, adds up each word's count over all
   blocks, and gives every block the counts of its words back, so no task holds all words.
3. Every round of Baum-Welch is one pass over the training texts: every block sums expected
   counts of its own words, ``totals`` adds them up per range of hashes and gives each block
   those of its words back. No task and no driver holds the emissions of all words; the
   driver has the start, the steps, the shared symbol and the sum per state.
4. Scores are exact. A text is cut into segments whose transfer matrices are computed side by
   side, rescaled every few steps, and then multiplied in order; so a long text takes no more
   steps than a short one. Training uses the same cut without approximation.

Cases: a null or empty text is the end alone; rows without an id are scored but not learned
from; repeated rows are scored alike and each counts; without training rows every word has
the base probability 1 (0.5 / 0.5); an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.scratch import discard, stored

#: Training tokens of a word that has emissions of its own.
LEAST = 2
STATES = 4
ROUNDS = 4

#: Text of a block that has a list of words of its own: the larger, the fewer words in all lists.
CHUNK_BYTES = 16 << 20

#: Hashes of all blocks' words that one range of hashes has about, and one task holds.
RANGE_BYTES = 16 << 20

#: Tokens of a segment, and bytes of token classes handled at once.
SEGMENT = 256
_CLASS_BYTES = 2 << 20

#: Steps inside a segment from one scaling to the next.
_RESCALE = 4

_U64 = np.uint64
#: Stands for the end; hashes of words are mixed, so none is likely to be this.
END = _U64(0x656E64)
#: Prior counts that each state's emissions get from the word frequencies.
_PRIOR = 50.0
#: In place of a word's number in its range: no emissions of its own.
_NONE = 0xFFFFFFFF


def _binary(values: np.ndarray, places: np.ndarray | None = None) -> pa.Array:
    places = np.array([0, len(values)]) if places is None else places
    offsets = np.ascontiguousarray(places * values.itemsize, dtype=np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers).cast(pa.binary())


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays([0, len(values)], values)


def _planes(values: np.ndarray, places: np.ndarray | None = None) -> pa.Array:
    """Rows of numbers of four bytes, each byte of them in a run of its own, compressed."""
    places = [0, len(values)] if places is None else places.tolist()
    codec = pa.Codec("zstd", compression_level=1)
    rows = [values[a:b].view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(places, places[1:], strict=False)]
    return pa.array([len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in rows], pa.binary())


def _numbers(planes: pa.Scalar, kind: str = "<u4") -> np.ndarray:
    raw = planes.as_py()
    raw = pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True)
    columns = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(columns.T).reshape(-1).view(kind)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``CHUNK_BYTES``; a longer one stays as it is."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > CHUNK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of the rows (doc_id, text, learn, held_out) as words and places in them."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for number, (batch, data, offsets) in enumerate(words.blocks(_gathered(batches), limit=CHUNK_BYTES)):
            lower = words.lower_ascii(data)
            starts, ends, first = words.spans(lower, offsets)
            tokens = np.insert(words.hashes(lower, starts, ends), first[1:], END)
            lengths = np.diff(first) + 1
            vocabulary, places = np.unique(tokens, return_inverse=True)
            learn = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            learned = places[np.repeat(learn, lengths)]
            counts = np.bincount(learned, minlength=len(vocabulary))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part + number], pa.int64()),
                    pa.array([len(learned)], pa.int64()),
                    _list(batch.column(0)),
                    _list(batch.column(2)),
                    _list(batch.column(3)),
                    _list(pa.array(lengths, pa.int64())),
                    _binary(vocabulary),
                    _binary(counts.astype("<u4")),
                    _planes(places.astype("<u4")),
                ],
                ["chunk", "n_learned", "doc_ids", "learn", "held_out", "lengths", "vocabulary", "counts", "tokens"],
            )

    return docs.mapInArrow(
        blocks,
        "chunk long, n_learned long, doc_ids array<long>, learn array<boolean>,"
        " held_out array<boolean>, lengths array<long>, vocabulary binary, counts binary, tokens binary",
    )


def count(chunks: DataFrame, least: int, ranges: int, states: int) -> DataFrame:
    """Total counts: for each chunk and range of hashes those of its words (``counts``) and
    their numbers among the range's words counted at least ``least`` times (``ids``); for each
    range, as chunk -1, its number of words, of such words (``n_explicit``), of their tokens
    (``n_tokens``), and their first weights per state (``weights``)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([k * (1 << 64) // ranges for k in range(1, ranges)], dtype=_U64)
        for batch in batches:
            for k in range(batch.num_rows):
                vocabulary = np.frombuffer(batch.column(1)[k].as_buffer(), dtype=_U64)
                counts = np.frombuffer(batch.column(2)[k].as_buffer(), dtype="<u4")
                places = np.concatenate(
                    [[0], np.searchsorted(vocabulary, bounds), [len(vocabulary)]]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(ranges, dtype=np.int32)),
                        pa.array(np.full(ranges, batch.column(0)[k].as_py())),
                        _binary(vocabulary, places),
                        _binary(counts, places),
                    ],
                    ["range", "chunk", "vocabulary", "counts"],
                )

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x.as_buffer(), dtype=_U64) for x in rows["vocabulary"]]
        counts = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in rows["counts"]]
        distinct, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct))
        total = total.astype("<u8")
        often = total >= least
        ids = np.where(often, np.cumsum(often) - 1, _NONE).astype("<u4")[inverse]
        weights = total[often] @ disturbed(distinct[often], states)
        sizes = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        places = np.append(sizes, sizes[-1])
        none = [0] * len(lists)
        chunk = np.append(rows["chunk"].to_numpy(), -1)
        return pa.table(
            [
                pa.array(chunk),
                pa.array(np.full(len(chunk), key[0].as_py(), dtype=np.int32)),
                pa.array([*none, np.count_nonzero(total)], pa.int64()),
                pa.array([*none, np.count_nonzero(often)], pa.int64()),
                pa.array([*none, int(total[often].sum())], pa.int64()),
                pa.array([*([None] * len(lists)), weights.tolist()], pa.list_(pa.float64())),
                _binary(total[inverse], places),
                _binary(ids, places),
            ],
            ["chunk", "range", "n_words", "n_explicit", "n_tokens", "weights", "counts", "ids"],
        )

    dealt = chunks.select("chunk", "vocabulary", "counts").mapInArrow(
        deal, "range int, chunk long, vocabulary binary, counts binary"
    )
    return dealt.groupBy("range").applyInArrow(
        add,
        "chunk long, range int, n_words long, n_explicit long, n_tokens long,"
        " weights array<double>, counts binary, ids binary",
    )


@dataclass(frozen=True)
class Vocabulary:
    """Totals of the training rows, and those of the words with emissions of their own."""

    tokens: int
    words: int
    explicit_tokens: int
    explicit_words: int
    weights: np.ndarray

    @property
    def rest(self) -> float:
        """Smoothed count of all words that are not explicit, an unknown one included."""
        seen = self.tokens - self.explicit_tokens
        return seen + 0.5 * (self.words - self.explicit_words) + 0.5

    @property
    def rest_share(self) -> float:
        return self.rest / (self.explicit_tokens + self.rest)


def vocabulary_of(counted: DataFrame, tokens: int, states: int) -> Vocabulary:
    """One row of sums reaches the driver."""
    found = counted.where(F.col("chunk") == -1)
    sums = found.agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_tokens", "n_explicit")),
        *(F.coalesce(F.sum(F.get("weights", F.lit(k))), F.lit(0.0)) for k in range(states)),
    ).first()
    return Vocabulary(tokens, sums[0], sums[1], sums[2], np.array(sums[3:]))


def classify(chunks: DataFrame, counted: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row per chunk: of its documents the ids, flags, numbers of tokens, base_score and the
    part of the score that does not depend on states (``rest_score``); of its explicit words
    hashes, counts, numbers in their ranges (``ids``) and how many of each range (``sizes``);
    and the tokens as places in those words, the next place for all others."""
    v = vocabulary

    def one(key: tuple, chunk: pa.Table, pieces: pa.Table) -> pa.Table:
        order = np.argsort(pieces["range"].to_numpy())
        parts, numbers = (
            [np.frombuffer(pieces[name][int(i)].as_buffer(), dtype=kind) for i in order]
            for name, kind in (("counts", "<u8"), ("ids", "<u4"))
        )
        total, ids = np.concatenate(parts), np.concatenate(numbers)
        counts = total.astype(np.float64)
        own = np.frombuffer(chunk["vocabulary"][0].as_buffer(), dtype=_U64)
        hit = ids != _NONE
        classes = np.where(hit, np.cumsum(hit) - 1, np.count_nonzero(hit)).astype("<u4")
        sizes = np.array([np.count_nonzero(x != _NONE) for x in numbers], dtype="<u4")
        logs = np.log10(counts + 0.5)
        rest = np.where(hit, 0.0, logs - math.log10(v.rest))
        tokens = _numbers(chunk["tokens"][0])
        lengths = chunk["lengths"].combine_chunks().flatten().to_numpy()
        doc = np.concatenate([[0], np.cumsum(lengths)[:-1]])  # every text has a token, so no run is empty
        sums = lambda x: np.add.reduceat(x[tokens], doc)
        smooth = math.log10(v.tokens + 0.5 * (v.words + 1))
        return pa.table(
            [
                *(chunk[name].combine_chunks() for name in ("chunk", "doc_ids", "learn", "held_out", "lengths")),
                _list(pa.array(sums((counts > 0).astype(np.int64)))),
                _list(pa.array(sums(logs) - lengths * smooth)),
                _list(pa.array(sums(rest))),
                _binary(own[hit]),
                _binary(total[hit]),
                _binary(ids[hit]),
                _binary(sizes),
                _planes(classes[tokens]),
            ],
            [
                "chunk", "doc_ids", "learn", "held_out", "lengths", "n_known", "base_score", "rest_score",
                "words", "counts", "ids", "sizes", "tokens",
            ],
        )

    pieces = counted.where(F.col("chunk") >= 0)
    pieces = pieces.select(F.col("chunk").alias("of_chunk"), "range", "counts", "ids")
    return (
        chunks.drop("counts", "n_learned")
        .groupBy("chunk")
        .cogroup(pieces.groupBy("of_chunk"))
        .applyInArrow(
            one,
            "chunk long, doc_ids array<long>, learn array<boolean>, held_out array<boolean>,"
            " lengths array<long>, n_known array<long>, base_score array<double>,"
            " rest_score array<double>, words binary, counts binary, ids binary, sizes binary, tokens binary",
        )
    )


@dataclass(frozen=True)
class Model:
    """A state before the first token (``start``), then for every token a step from state to
    state (``steps``) and a symbol (``emit``, symbols x states)."""

    start: np.ndarray
    steps: np.ndarray
    emit: np.ndarray


def disturbed(hashes: np.ndarray, states: int) -> np.ndarray:
    """A factor from 0.5 to 1.5 for each word and state, the same wherever the word is met."""
    salts = words.mix(np.arange(5, 5 + states, dtype=_U64))
    return (words.mix(hashes[:, None] ^ salts) >> _U64(11)) / float(1 << 53) + 0.5


#: Stands for all words without emissions of their own.
_REST = np.array([0x72657374], dtype=_U64)


@dataclass(frozen=True)
class Parameters:
    """What all tasks know of a model: start, steps, the shared symbol's emissions (``rest``)
    and the sum over all symbols per state that emissions are divided by (``whole``)."""

    start: np.ndarray
    steps: np.ndarray
    rest: np.ndarray
    whole: np.ndarray
    prior: float

    def model(self, weights: np.ndarray) -> Model:
        """The model over some explicit words with these weights, and the shared symbol."""
        return Model(self.start, self.steps, np.concatenate([weights / self.whole, self.rest[None]]))

    def weights(self, sums: np.ndarray) -> np.ndarray:
        """Of expected counts: a word's counts over all states are its training tokens, so its
        share of the prior comes from them."""
        return sums + self.prior * sums.sum(axis=1, keepdims=True)


def first_parameters(vocabulary: Vocabulary, states: int) -> Parameters:
    """Word frequencies, disturbed apart for each state so that training can tell them apart."""
    steps = np.full((states, states), 1 / states) + np.eye(states)
    rest = vocabulary.rest * disturbed(_REST, states)[0]
    whole = vocabulary.weights + rest
    prior = _PRIOR / (vocabulary.explicit_tokens + vocabulary.rest)
    start = np.full(states, 1 / states)
    return Parameters(start, steps / steps.sum(axis=1, keepdims=True), rest / whole, whole, prior)


def next_parameters(sums: np.ndarray, vocabulary: Vocabulary, before: Parameters) -> Parameters:
    """The most likely model for expected counts, with a prior towards the frequencies.

    ``sums`` has those of the start, the steps, the shared symbol and all explicit words.
    """
    states = len(before.start)
    start, steps, rest, explicit = np.split(sums, np.cumsum([states, states * states, states]))
    start, steps = start + 0.5, steps.reshape(states, states) + 0.5
    rest = rest + _PRIOR * vocabulary.rest_share
    whole = explicit + rest + _PRIOR * (1 - vocabulary.rest_share)
    return Parameters(
        start / start.sum(), steps / steps.sum(axis=1, keepdims=True), rest / whole, whole, before.prior
    )


@dataclass(frozen=True)
class Segments:
    """Texts cut into segments: first token, tokens and first segment of each text."""

    begin: np.ndarray
    size: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(places: np.ndarray) -> Segments:
        lengths = np.diff(places)
        number = -(-lengths // SEGMENT)
        first = np.concatenate([[0], np.cumsum(number)])
        text = np.repeat(np.arange(len(lengths)), number)
        turn = np.arange(first[-1]) - first[:-1][text]
        begin = places[:-1][text] + turn * SEGMENT
        return Segments(begin, np.minimum(SEGMENT, places[1:][text] - begin), first)

    def by_step(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments by falling size (those with a given step are then the first ones), tokens
        step by step in that order, and the first place of each step among them."""
        order = np.argsort(-self.size, kind="stable")
        begin, falling = self.begin[order], -self.size[order]
        longest = int(-falling[0]) if len(falling) else 0
        on = np.searchsorted(falling, -np.arange(longest))
        tokens = [begin[:n] + step for step, n in enumerate(on)]
        return order, np.concatenate([*tokens, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum(on)])


def _emissions(model: Model, symbols: np.ndarray) -> np.ndarray:
    """States x tokens, each token's greatest one: what its states have in common is left out."""
    shares = model.emit / model.emit.max(axis=1, keepdims=True)
    return np.ascontiguousarray(shares.T)[:, symbols]


def _slices(places: np.ndarray) -> Iterator[tuple[int, slice]]:
    return ((step, slice(a, b)) for step, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)))


def transfers(model: Model, emitted: np.ndarray, places: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled matrix (from x to x segments) from the state before each segment, by falling size,
    to the one at its end, and the log."""
    states = len(model.start)
    matrix = np.repeat(np.eye(states)[:, :, None], segments, axis=2)
    log = np.zeros(segments)
    back = np.ascontiguousarray(model.steps.T)

    def rescale(n: int) -> None:
        scale = matrix[:, :, :n].sum(axis=(0, 1))
        matrix[:, :, :n] /= scale
        log[:n] += np.log(scale)

    for step, at in _slices(places):
        n = at.stop - at.start
        np.multiply(back @ matrix[:, :, :n], emitted[:, at], out=matrix[:, :, :n])
        if step % _RESCALE == 0:
            rescale(n)
    rescale(segments)
    return matrix, log


def _turns(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each place in the row of a text's segments, the texts that have one there."""
    number = np.diff(first)
    for turn in range(int(number.max()) if len(number) else 0):
        texts = np.flatnonzero(number > turn)
        yield texts, first[:-1][texts] + turn


def _by_text(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The matrices of segments by falling size as segments x from x to, in the order of the texts."""
    out = np.empty((len(order), *matrix.shape[:2]))
    out[order] = np.moveaxis(matrix, 2, 0)
    return out


def log_likelihood(model: Model, classes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each text's classes."""
    cut = Segments.of(places)
    order, tokens, at = cut.by_step()
    falling, scales = transfers(model, _emissions(model, classes[tokens]), at, len(order))
    matrix, log = _by_text(falling, order), np.empty(len(order))
    log[order] = scales
    texts = len(places) - 1
    state = np.repeat(model.start[None], texts, axis=0)
    of_text = np.repeat(np.arange(texts), np.diff(places))
    total = np.bincount(of_text, weights=np.log(model.emit.max(axis=1))[classes], minlength=texts)
    for on, segment in _turns(cut.first):
        moved = np.einsum("ti,tij->tj", state[on], matrix[segment])
        scale = moved.sum(axis=1)
        state[on] = moved / scale[:, None]
        total[on] += np.log(scale) + log[segment]
    return total


@dataclass
class Expected:
    """Expected counts of a pass: start, steps and emissions (states x symbols)."""

    start: np.ndarray
    steps: np.ndarray
    emit: np.ndarray

    def add(self, model: Model, classes: np.ndarray, places: np.ndarray) -> None:
        states = len(model.start)
        cut = Segments.of(places)
        order, tokens, at = cut.by_step()
        symbols = classes[tokens]
        emitted = _emissions(model, symbols)
        matrix = _by_text(transfers(model, emitted, at, len(order))[0], order)
        texts = len(places) - 1
        before = np.empty((len(cut.size), states))
        state = np.repeat(model.start[None], texts, axis=0)
        turns = list(_turns(cut.first))
        for on, segment in turns:
            before[segment] = state[on]
            moved = np.einsum("ti,tij->tj", state[on], matrix[segment])
            state[on] = moved / moved.sum(axis=1, keepdims=True)
        behind = np.empty_like(before)
        state = np.ones((texts, states))
        for on, segment in reversed(turns):
            behind[segment] = state[on]
            moved = np.einsum("tij,tj->ti", matrix[segment], state[on])
            state[on] = moved / moved.sum(axis=1, keepdims=True)
        first = model.start * state
        self.start += (first / first.sum(axis=1, keepdims=True)).sum(axis=0)
        # Chances of the states and the tokens up to each one, scaled now and then.
        forward = np.empty((states, len(symbols)))
        at_start = np.ascontiguousarray(before[order].T)
        last = np.empty_like(at_start)
        back = np.ascontiguousarray(model.steps.T)
        slices, scales = list(_slices(at)), {}
        for step, here in slices:
            n = here.stop - here.start
            state = forward[:, slices[step - 1][1]][:, :n] if step else at_start
            if step and step % _RESCALE == 0:
                scales[step - 1] = state.sum(axis=0)
                state /= scales[step - 1]
            last[:, :n] = np.multiply(back @ state, emitted[:, here], out=forward[:, here])
        # Chances of the tokens after each one, scaled so that those of all states times ``forward``
        # add up to one: then they do at the step before, too, if its scale is taken along.
        state = np.ascontiguousarray(behind[order].T)
        state /= (last * state).sum(axis=0)
        moves = np.zeros((states, states))
        for step, here in reversed(slices):
            n = here.stop - here.start
            come = emitted[:, here] * state[:, :n]
            forward[:, here] *= state[:, :n]
            if step in scales:
                come[:, : len(scales[step])] /= scales[step]
            moves += (forward[:, slices[step - 1][1]][:, :n] if step else at_start) @ come.T
            np.matmul(model.steps, come, out=state[:, :n])
        self.steps += model.steps * moves
        for k in range(states):
            self.emit[k] += np.bincount(symbols, weights=forward[k], minlength=self.emit.shape[1])


def _runs(lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Texts of a chunk in runs of at most ``_CLASS_BYTES`` of classes, or one longer text, and
    the places of their tokens."""
    places = np.concatenate([[0], np.cumsum(lengths)])
    text = 0
    while text < len(lengths):
        end = int(np.searchsorted(places, places[text] + _CLASS_BYTES // 4, side="right")) - 1
        end = min(max(end, text + 1), len(lengths))
        yield slice(text, end), places[text : end + 1]
        text = end


def _model_of(chunk: pa.Table, pieces: pa.Table | None, known: Parameters) -> Model:
    """The model over a chunk's own words, from their counts (``pieces`` is None) or from their
    expected counts in ``pieces``."""
    states = len(known.start)
    if pieces is None:
        own, counts = (
            np.frombuffer(chunk[name][0].as_buffer(), dtype=kind) for name, kind in (("words", _U64), ("counts", "<u8"))
        )
        return known.model(counts[:, None] * disturbed(own, states))
    order = np.argsort(pieces["range"].to_numpy())
    sums = [_numbers(pieces["sums"][int(i)], "<f4") for i in order]
    return known.model(known.weights(np.concatenate(sums).astype(np.float64).reshape(-1, states)))


_EXPECTED = "chunk long, range int, ids binary, sums binary, totals array<double>"


def _expect(chunk: pa.Table, pieces: pa.Table | None, known: Parameters) -> pa.Table:
    """Expected counts of a chunk: a row per range for its words, and as range -1 all sums."""
    states = len(known.start)
    model = _model_of(chunk, pieces, known)
    found = Expected(np.zeros(states), np.zeros((states, states)), np.zeros((states, len(model.emit))))
    flat = lambda name: chunk[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    lengths, learn, tokens = flat("lengths"), flat("learn").astype(bool), _numbers(chunk["tokens"][0])
    tokens = tokens[np.repeat(learn, lengths)].astype("<i4")
    for _, places in _runs(lengths[learn]):
        found.add(model, tokens[places[0] : places[-1]], places - places[0])
    words_of = np.ascontiguousarray(found.emit[:, :-1].T)
    totals = np.concatenate([found.start, found.steps.reshape(-1), found.emit[:, -1], words_of.sum(axis=0)])
    sizes = np.frombuffer(chunk["sizes"][0].as_buffer(), dtype="<u4").astype(np.int64)
    ids = np.frombuffer(chunk["ids"][0].as_buffer(), dtype="<u4")
    # Ranges without words of the chunk are left out, but never all of them.
    used = np.flatnonzero((sizes > 0) | (np.arange(len(sizes)) == 0))
    places = np.concatenate([[0], np.cumsum(sizes[used]), [sizes.sum()]])
    return pa.table(
        [
            pa.array(np.full(len(used) + 1, chunk["chunk"][0].as_py())),
            pa.array(np.append(used, -1).astype(np.int32)),
            _binary(ids, places),
            _planes(words_of.astype("<f4").reshape(-1), places * states),
            pa.array([*([None] * len(used)), totals.tolist()], pa.list_(pa.float64())),
        ],
        ["chunk", "range", "ids", "sums", "totals"],
    )


def totals(expected: DataFrame, states: int) -> DataFrame:
    """Expected counts of each word over all chunks, for each chunk and range those of its words.

    They travel in four bytes and are added in eight."""

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in rows["ids"]]
        total = np.zeros((max((int(x.max()) + 1 for x in ids if len(x)), default=0), states))
        for own, part in zip(ids, rows["sums"], strict=True):
            total[own] += _numbers(part, "<f4").reshape(-1, states)
        places = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        back = total[np.concatenate(ids)].astype("<f4").reshape(-1)
        return pa.table(
            [rows["chunk"].combine_chunks(), rows["range"].combine_chunks(), _planes(back, places * states)],
            ["of_chunk", "range", "sums"],
        )

    rows = expected.where(F.col("range") >= 0).select("chunk", "range", "ids", "sums")
    return rows.groupBy("range").applyInArrow(add, "of_chunk long, range int, sums binary")


def expected_counts(texts: DataFrame, before: DataFrame | None, known: Parameters) -> DataFrame:
    """One pass of Baum-Welch over the training rows of ``texts``, with the emissions that the
    expected counts ``before`` give; the first pass has none."""
    columns = ["chunk", "learn", "lengths", "tokens", "ids", "sizes"]
    if before is None:

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from _expect(pa.Table.from_batches([batch.slice(k, 1)]), None, known).to_batches()

        return texts.select(*columns, "words", "counts").mapInArrow(collect, _EXPECTED)
    back = totals(before, len(known.start))
    return (
        texts.select(*columns)
        .groupBy("chunk")
        .cogroup(back.groupBy("of_chunk"))
        .applyInArrow(lambda _, chunk, pieces: _expect(chunk, pieces, known), _EXPECTED)
    )


def likelihoods(texts: DataFrame, before: DataFrame | None, known: Parameters) -> DataFrame:
    """A row per document with its score, under the same model as ``expected_counts``."""
    columns = ["doc_ids", "held_out", "lengths", "n_known", "base_score", "rest_score"]

    def score(chunk: pa.Table, pieces: pa.Table | None) -> pa.Table:
        model = _model_of(chunk, pieces, known)
        flat = [chunk[name].combine_chunks().flatten() for name in columns]
        tokens = _numbers(chunk["tokens"][0]).astype("<i4")
        out = flat[5].to_numpy().copy()
        for texts_of, places in _runs(flat[2].to_numpy()):
            found = log_likelihood(model, tokens[places[0] : places[-1]], places - places[0])
            out[texts_of] += found / math.log(10)
        return pa.table(
            [*flat[:5], pa.array(out)], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        )

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    if before is None:

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from score(pa.Table.from_batches([batch.slice(k, 1)]), None).to_batches()

        return texts.select("chunk", *columns, "tokens", "words", "counts").mapInArrow(collect, kinds)
    back = totals(before, len(known.start))
    return (
        texts.select("chunk", *columns, "tokens")
        .groupBy("chunk")
        .cogroup(back.groupBy("of_chunk"))
        .applyInArrow(lambda _, chunk, pieces: score(chunk, pieces), kinds)
    )


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends: every job here stores its result."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scored(docs: DataFrame, learn: Column, held_out: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``learn`` chooses the rows to learn from, ``held_out`` is kept with each.
    """
    spark = docs.sparkSession
    flag = lambda c: F.coalesce(c, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", flag(learn).alias("learn"), flag(held_out).alias("held_out")
    )
    with _shuffles_removed(spark):
        chunks = stored(encode(rows), "chunks")
        tokens, size = chunks.agg(
            F.coalesce(F.sum("n_learned"), F.lit(0)), F.coalesce(F.sum(F.octet_length("vocabulary")), F.lit(0))
        ).first()
        ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
        counted = stored(count(chunks, LEAST, ranges, states), "counted")
        vocabulary = vocabulary_of(counted, tokens, states)
        texts = stored(classify(chunks, counted, vocabulary), "classes")
        discard(chunks)
        discard(counted)
        known, expected = first_parameters(vocabulary, states), None
        for _ in range(rounds if tokens else 0):
            found = stored(expected_counts(texts, expected, known), "expected")
            if expected is not None:
                discard(expected)
            expected = found
            sums = expected.where(F.col("range") == -1).select(F.posexplode("totals").alias("place", "sum"))
            sums = {r[0]: r[1] for r in sums.groupBy("place").agg(F.sum("sum")).collect()}
            known = next_parameters(np.array([sums[k] for k in range(len(sums))]), vocabulary, known)
    return likelihoods(texts, expected, known).withColumn("train_tokens", F.lit(tokens).cast("long"))
