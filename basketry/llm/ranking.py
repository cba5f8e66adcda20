"""Ranked lexical search: the best documents of every query, by lists read in order of impact.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower
case. With N documents that hold a term, L terms in them, n in a document, df documents with a term and
tf its occurrences in one, a term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and gives a
document that weight times ``10**9 tf div (1000 tf + 20 m)``, where m is ``50 + 50 n N div L``.

* Postings of the query terms are gathered in one pass over whole texts, in segments of at most
  ``SEGMENT_DOCUMENTS`` documents. N, L and df are sums over all segments.
* Each segment sorts the list of each term by impact. For each query its lists are read from the
  top in step (no random access, after the NRA algorithm). A document's lower bound is the sum of
  what was read of it, its upper bound adds for each list where it has not come up the impact
  now reached there. Reading goes on until no unseen document can reach the k-th
  lower bound, no seen one outside the k best can, and all that can, ties included, have equal
  bounds: their final scores.
* A task carries the k best of each query from one segment to the next, so that later segments
  stop sooner or are not read at all. The k best of all tasks are ranked together.

Queries are handled in groups of at most ``QUERIES`` queries and about ``TERMS`` terms, whose terms
are sent to every task; more queries make more groups. Terms are compared by 64-bit hashes.

Cases: a null text, or one without terms, is no document of the statistics and a query without
results; a null doc_id is ranked after all others of its score; repeated rows are documents of
their own; queries with one item_id are one query with the terms of all; empty tables give an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import words
from basketry.llm.scratch import importable, stored

SEGMENT_DOCUMENTS = 1 << 14
SEGMENT_POSTINGS = 1 << 20
#: Queries, and about how many of their terms, that are handled at once.
QUERIES = 4096
TERMS = 1 << 20
#: Entries of each list read first; every turn reads as many again as all before it.
FIRST_READ = 16

#: Bytes that end a term.
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_U64 = np.uint64


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and the first term of each text."""
    lower = words.lower_ascii(data)
    starts, ends, first = words.spans(lower, offsets, _SEPARATOR)
    return words.hashes(lower, starts, ends), first


def query_terms(items: DataFrame) -> DataFrame:
    """item_id and the hash of every term of its texts, each once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in words.blocks(batches):
            value, first = _terms(data, offsets)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(value.view(np.int64))], ["item_id", "term"]
            )

    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(read, "item_id long, term long").distinct()


@dataclass
class Queries:
    """A group of queries: their terms, numbered, and which of them each query has."""

    vocabulary: np.ndarray  # hashes, ascending
    ids: list[int | None]
    first: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(found: pa.Table) -> Queries:
        value = found["term"].to_numpy().view(_U64)
        vocabulary, number = np.unique(value, return_inverse=True)
        ids: dict[int | None, int] = {}
        owner = np.array([ids.setdefault(x, len(ids)) for x in found["item_id"].to_pylist()], dtype=np.int64)
        order = np.lexsort((number, owner))
        first = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        return Queries(vocabulary, list(ids), first, number[order])


_SEGMENT = "ids array<long>, lengths binary, terms array<int>, counts array<int>, docs binary, times binary, n_docs long, n_terms long"


def _segments(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Postings of the terms in ``vocabulary``, by term, for some documents at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def write(parts: list[tuple]) -> pa.RecordBatch:
        ids = pa.concat_arrays([part[0] for part in parts])
        lengths = np.concatenate([part[1] for part in parts])
        before = np.cumsum([0, *(len(part[1]) for part in parts)])
        doc = np.concatenate([part[2] + start for part, start in zip(parts, before, strict=False)])
        term = np.concatenate([part[3] for part in parts])
        times = np.concatenate([part[4] for part in parts])
        order = np.argsort(term, kind="stable")
        present, counts = np.unique(term, return_counts=True)
        # Documents without any of the terms are only counted.
        used, number = np.unique(doc[order], return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids.take(pa.array(used)).to_pylist()], pa.list_(pa.int64())),
                pa.array([lengths[used].astype("<i8").tobytes()], pa.binary()),
                pa.array([present.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([number.astype("<u2").tobytes()], pa.binary()),
                pa.array([times[order].astype("<i4").tobytes()], pa.binary()),
                pa.array([int((lengths > 0).sum())], pa.int64()),
                pa.array([int(lengths.sum())], pa.int64()),
            ],
            ["ids", "lengths", "terms", "counts", "docs", "times", "n_docs", "n_terms"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held: list[tuple] = []
        documents = postings = 0
        for batch, data, offsets in words.blocks(batches):
            for low in range(0, batch.num_rows, SEGMENT_DOCUMENTS):
                high = min(low + SEGMENT_DOCUMENTS, batch.num_rows)
                if documents + high - low > SEGMENT_DOCUMENTS or postings > SEGMENT_POSTINGS:
                    yield write(held)
                    held, documents, postings = [], 0, 0
                start, end = int(offsets[low]), int(offsets[high])
                value, first = _terms(data[start:end], offsets[low : high + 1] - start)
                owner = np.repeat(np.arange(high - low), np.diff(first))
                at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
                hit = known[at] == value if len(known) else np.zeros(len(value), dtype=bool)
                code, times = np.unique(owner[hit] * np.int64(len(known)) + at[hit], return_counts=True)
                doc, term = np.divmod(code, max(len(known), 1))
                held.append((batch.column(0).slice(low, high - low), np.diff(first), doc, term, times))
                documents += high - low
                postings += len(code)
        if held:
            yield write(held)

    return docs.mapInArrow(gather, _SEGMENT)


def impacts(weight: np.ndarray, times: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a term gives a document, in whole numbers."""
    m = 50 + (50 * length * n) // total
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * m))


@dataclass
class Lists:
    """Lists of postings by term, each in descending order of impact."""

    first: np.ndarray  # of each term of the vocabulary, and one more
    docs: np.ndarray
    impact: np.ndarray
    size: int  # documents

    @staticmethod
    def of(term: np.ndarray, docs: np.ndarray, impact: np.ndarray, terms: int, size: int) -> Lists:
        order = np.lexsort((docs, -impact, term))
        return Lists(np.searchsorted(term[order], np.arange(terms + 1)), docs[order], impact[order], size)


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, or 1: what counts is above 0."""
    if len(scores) < k:
        return 1
    return max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))


def read_best(lists: Lists, terms: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the k best, all ties included, with their final scores.

    ``known`` has scores of documents elsewhere that compete with them.
    """
    start, end = lists.first[terms], lists.first[terms + 1]
    start, end = start[end > start], end[end > start]
    none = np.zeros(0, dtype=np.int64)
    if not len(start) or int(lists.impact[start].sum()) < _kth(known, k):
        return none, none
    read_list, read_doc, read_impact = none, none, none
    depth, goal = 0, FIRST_READ
    while True:
        low, high = np.minimum(start + depth, end), np.minimum(start + goal, end)
        number = high - low
        own = np.repeat(np.arange(len(start)), number)
        place = np.arange(len(own)) - np.repeat(np.cumsum(number) - number, number) + low[own]
        read_list = np.concatenate([read_list, own])
        read_doc = np.concatenate([read_doc, lists.docs[place]])
        read_impact = np.concatenate([read_impact, lists.impact[place]])
        # The impact reached in each list; nothing is left of one read to its end.
        reached = np.where(high < end, lists.impact[np.minimum(high, end - 1)], 0)
        # Sums stay below 2**53, where doubles are exact.
        lower = np.bincount(read_doc, read_impact, lists.size).astype(np.int64)
        passed = np.bincount(read_doc, reached[read_list], lists.size).astype(np.int64)
        unseen = int(reached.sum())
        upper = lower + unseen - passed
        least = _kth(np.concatenate([known, lower[lower > 0]]), k)
        able = np.flatnonzero((upper >= least) & (lower > 0))
        if unseen < least and np.array_equal(lower[able], upper[able]):
            return able, lower[able]
        depth, goal = goal, 2 * goal


def _ranked_segments(
    segments: DataFrame, queries: Queries, weight: np.ndarray, n: int, total: int, k: int
) -> DataFrame:
    """item_id, doc_id and score of the k best documents of every task."""
    shared = segments.sparkSession.sparkContext.broadcast((queries, weight))

    def merge(best: tuple[np.ndarray, list], scores: np.ndarray, ids: list) -> tuple[np.ndarray, list]:
        scores = np.concatenate([best[0], scores])
        ids = best[1] + ids
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[:k]
        return scores[order], [ids[i] for i in order]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, heavy = shared.value
        best: list[tuple[np.ndarray, list]] = [(np.zeros(0, dtype=np.int64), [])] * len(asked.ids)
        for batch in batches:
            for row in range(batch.num_rows):
                column = dict(zip(batch.schema.names, batch.columns, strict=True))
                ids = column["ids"][row].values
                length = np.frombuffer(column["lengths"][row].as_buffer(), dtype="<i8")
                counts = column["counts"][row].values.to_numpy()
                term = np.repeat(column["terms"][row].values.to_numpy().astype(np.int64), counts)
                docs = np.frombuffer(column["docs"][row].as_buffer(), dtype="<u2").astype(np.int64)
                times = np.frombuffer(column["times"][row].as_buffer(), dtype="<i4").astype(np.int64)
                value = impacts(heavy[term], times, length[docs], n, total)
                lists = Lists.of(term, docs, value, len(heavy), len(length))
                for query in range(len(asked.ids)):
                    wanted = asked.terms[asked.first[query] : asked.first[query + 1]]
                    found, scores = read_best(lists, wanted, k, best[query][0])
                    if len(found):
                        best[query] = merge(best[query], scores, ids.take(pa.array(found)).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, (_, ids) in zip(asked.ids, best, strict=True) for _ in ids], pa.int64()),
                pa.array([i for _, ids in best for i in ids], pa.int64()),
                pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *(scores for scores, _ in best)])),
            ],
            ["item_id", "doc_id", "score"],
        )

    return segments.mapInArrow(rank, "item_id long, doc_id long, score long")


def _best_of_group(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    segments = stored(_segments(docs, queries.vocabulary), "postings")
    sums = segments.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = sums["n"] or 0, sums["total"] or 1
    holding = segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms")
    holding = holding.agg(F.sum("x.counts").alias("df")).toArrow()  # a row per term of the group
    df = np.zeros(len(queries.vocabulary), dtype=np.int64)
    df[holding["terms"].to_numpy()] = holding["df"].to_numpy()
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()]
    return _ranked_segments(segments, queries, np.array(weight, dtype=np.int64), n, total, k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score: the k best documents above 0 of every query."""
    importable(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = stored(query_terms(items), "query-terms")
    size = asked.agg(F.count("*").alias("terms"), F.count_distinct(F.coalesce("item_id", F.lit(-1))).alias("queries"))
    size = size.first()
    groups = max(1, math.ceil(size["terms"] / TERMS), math.ceil(size["queries"] / QUERIES))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    found = None
    for number in range(groups):
        queries = Queries.of(asked.where(group == number).toArrow())
        best = _best_of_group(texts, queries, k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
