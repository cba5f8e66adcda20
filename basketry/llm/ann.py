"""Nearest neighbours by inner product through cross-polytope hashing.

Vectors are made unit vectors for hashing by one more component (so that the largest inner
product is the smallest angle), padded to a power of two and pseudo-rotated by three rounds
of random signs and the fast Hadamard transform. Each of ``tables`` rotations assigns a
vector to its nearest signed axis. A query looks into the ``probes`` axes nearest to it in
each table, and the rows found there are ranked by their exact inner products.

Equal vectors are one class: hashed and compared once, and of its rows only the ``k + 1``
smallest ids can be among the nearest, so a vector repeated without end costs no more. Large
buckets are split into blocks of about ``BLOCK_ROWS`` vectors, and their queries likewise.
Queries for which the tables hold too few rows are compared with all rows, block by block.

Cases: rows whose id is null, or whose vector is null, zero, of another length than ``dim``
or holds a null or non-finite component take no part, neither as query nor as candidate;
rows repeated with their id count once; equal products are ordered by id; with fewer than
``k`` other rows all of them are returned; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.scratch import stored

#: Vectors, or queries, of one block.
BLOCK_ROWS = 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Each row times the Hadamard matrix (the number of columns is a power of two)."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        x = x.reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


@lru_cache(maxsize=8)
def _signs(tables: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, 3, width))


def rotated(x: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """Pseudo-rotations of unit rows: tables x rows x width."""
    width = 1 << (x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    out = np.empty((tables, len(x), width))
    for t, rounds in enumerate(_signs(tables, width, seed)):
        y = padded
        for signs in rounds:
            y = hadamard(y * signs)
        out[t] = y
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lists(values: np.ndarray, width: int) -> pa.Array:
    offsets = np.arange(0, values.size + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def usable(vectors: DataFrame, vec_id: str, vector: str, dim: int) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    ok = F.col(vec_id).isNotNull() & (F.size(v) == dim) & finite & F.exists(v, lambda c: c != 0)
    rows = vectors.where(ok)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"))


def classes_of(rows: DataFrame, k: int, is_query: Column) -> DataFrame:
    """One row per distinct vector: its smallest id, its ``k + 1`` smallest ids, any query."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.select("vec_id", "vector").distinct()
    first = first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    members = first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    asked = rows.where(is_query).select("vector").distinct().withColumn("asked", F.lit(True))
    return members.join(asked, "vector", "left").select(
        F.col("members")[0].alias("class_id"), "members", "vector", F.coalesce("asked", F.lit(False)).alias("asked")
    )


def hashed(classes: DataFrame, dim: int, tables: int, probes: int, longest: float, seed: int) -> DataFrame:
    """Adds ``bucket`` of each table, and for queries the ``probed`` buckets of each table."""

    def assign(batches):
        for batch in batches:
            x = _matrix(batch.column("vector"), dim)
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            rest = np.sqrt(np.maximum(longest**2 - norm**2, 0))
            z = rotated(np.hstack([x, rest]) / longest, tables, seed)
            axis = np.abs(z).argmax(axis=2)
            sign = np.take_along_axis(z, axis[:, :, None], 2)[:, :, 0] < 0
            bucket = (axis * 2 + sign).T.astype(np.int32)
            ask = np.flatnonzero(batch.column("asked").to_numpy(zero_copy_only=False))
            q = rotated(np.hstack([x, 0 * rest])[ask] / norm[ask], tables, seed)
            near = np.stack([q, -q], axis=3).reshape(tables, len(ask), 2 * q.shape[2])
            probed = np.argsort(-near, axis=2, kind="stable")[:, :, :probes]
            probed = probed.transpose(1, 0, 2).reshape(len(ask), tables * probes).astype(np.int32)
            sizes = np.zeros(len(x), dtype=np.int64)
            sizes[ask] = probed.shape[1]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    _lists(bucket, tables),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(probed.reshape(-1))),
                ],
                [*batch.schema.names, "bucket", "probed"],
            )

    return classes.mapInArrow(
        assign,
        "class_id long, members array<long>, vector array<double>, asked boolean,"
        " bucket array<int>, probed array<int>",
    )


def best_in_groups(index: DataFrame, queries: DataFrame, keys: list[str], k: int, dim: int) -> DataFrame:
    """The best ``k + 1`` classes for each query within each group of equal keys."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_class", "classes", "scores"]
        if not len(left) or not len(right):
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
            return pa.table([pa.array([], kind) for kind in kinds], names)
        ids = left["class_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], _matrix(left["vector"], dim)[order]
        scores = _matrix(right["query_vector"], dim) @ x.T
        top = min(k + 1, len(ids))
        if top < len(ids):
            # All that reach the last place count, so that ties go to the smaller id.
            bar = np.partition(scores, len(ids) - top, axis=1)[:, len(ids) - top]
            kept = np.where(scores >= bar[:, None], scores, -np.inf)
            picked = np.argsort(-kept, axis=1, kind="stable")[:, :top]
        else:
            picked = np.argsort(-scores, axis=1, kind="stable")
        found = np.take_along_axis(scores, picked, 1)
        return pa.table([right["query_class"], _lists(ids[picked], top), _lists(found, top)], names)

    renamed = [F.col("class_id").alias("query_class"), F.col("vector").alias("query_vector")]
    queries = queries.select(*keys, *renamed)
    return (
        index.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(best, "query_class long, classes array<long>, scores array<double>")
    )


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k + 1`` of all a query found: query_class, class_id, score."""

    def best(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = rows["classes"].combine_chunks().flatten().to_numpy()
        scores = rows["scores"].combine_chunks().flatten().to_numpy()
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        order = np.argsort(-scores, kind="stable")[: k + 1]
        query = pa.array(np.full(len(order), key[0].as_py()))
        names = ["query_class", "class_id", "score"]
        return pa.table([query, pa.array(ids[order]), pa.array(scores[order])], names)

    return found.groupBy("query_class").applyInArrow(
        best, "query_class long, class_id long, score double"
    )


def _by_buckets(classes: DataFrame, k: int, dim: int, tables: int, probes: int) -> DataFrame:
    index = classes.select("class_id", "vector", F.posexplode("bucket").alias("table", "bucket"))
    asked = classes.where("asked").select(
        "class_id", "vector", F.posexplode("probed").alias("place", "bucket")
    )
    asked = asked.withColumn("table", (F.col("place") / probes).cast("int")).drop("place")
    keys = ["table", "bucket"]
    # A row per bucket of each table, however many vectors there are.
    blocks = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / BLOCK_ROWS).cast("int")
    counts = index.groupBy(*keys).agg(F.count("*").alias("n"))
    counts = counts.join(asked.groupBy(*keys).agg(F.count("*").alias("m")), keys, "left")
    split = stored(
        counts.select(*keys, blocks(F.col("n")).alias("blocks"), blocks(F.col("m")).alias("groups")),
        "buckets",
    )
    mine = lambda n: F.pmod(F.xxhash64("class_id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    index = index.join(F.broadcast(split), keys)
    index = index.withColumn("block", mine(F.col("blocks"))).withColumn("group", each(F.col("groups")))
    asked = asked.join(F.broadcast(split), keys)
    asked = asked.withColumn("group", mine(F.col("groups"))).withColumn("block", each(F.col("blocks")))
    columns = [*keys, "block", "group"]
    index, asked = (f.select(*columns, "class_id", "vector") for f in (index, asked))
    return merged(best_in_groups(index, asked, columns, k, dim), k)


def _by_all(classes: DataFrame, few: DataFrame, n: int, k: int, dim: int) -> DataFrame:
    """Exact search for the queries ``few``: each meets every block of vectors."""
    m = few.count()
    blocks, groups = -(-n // BLOCK_ROWS), -(-m // BLOCK_ROWS)
    mine = lambda n: F.pmod(F.xxhash64("class_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = classes.select("class_id", "vector", mine(blocks).alias("block"), each(groups).alias("group"))
    asked = classes.join(few, "class_id", "left_semi")
    asked = asked.select("class_id", "vector", mine(groups).alias("group"), each(blocks).alias("block"))
    return merged(best_in_groups(index, asked, ["block", "group"], k, dim), k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    dim: int = 64,
    tables: int = 8,
    probes: int = 24,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest rows of each query.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    probes = min(probes, 2 << dim.bit_length())
    rows = usable(vectors, vec_id, vector, dim)
    classes = classes_of(rows, k, is_query)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, c: s + c * c))
    longest = rows.agg(F.max(norm)).first()[0] or 1.0
    classes = stored(hashed(classes, dim, tables, probes, longest, seed), "classes")
    size = F.size("members")
    n, total, asked = classes.agg(F.count("*"), F.sum(size), F.count_if("asked")).first()
    best = stored(_by_buckets(classes, k, dim, tables, probes), "nearest")
    with_members = best.join(classes.select("class_id", "members"), "class_id")
    enough = with_members.groupBy("query_class").agg(F.sum(size).alias("rows"))
    enough = enough.where(F.col("rows") >= min(k + 1, total or 0))
    few = classes.where("asked").join(
        enough, F.col("class_id") == F.col("query_class"), "left_anti"
    ).select("class_id")
    if asked and not few.isEmpty():
        few = stored(few, "few")
        exact = _by_all(classes, few, n, k, dim)
        done = few.withColumnRenamed("class_id", "query_class")
        best = best.join(done, "query_class", "left_anti").unionByName(exact)
        with_members = best.join(classes.select("class_id", "members"), "class_id")
    # At most k + 1 classes of k + 1 members for each query vector.
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("less"), F.col("member").alias("vec_id")))
    )
    lists = with_members.select("query_class", "score", F.explode("members").alias("member"))
    lists = lists.groupBy("query_class").agg(F.slice(ordered, 1, k + 1).alias("near"))
    lists = lists.join(
        classes.select(F.col("class_id").alias("query_class"), "vector"), "query_class"
    ).select("vector", "near")
    queries = rows.where(is_query).distinct().withColumnRenamed("vec_id", "query_id")
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    result = queries.join(lists, "vector").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "found")
    )
    return result.select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("found.vec_id").alias("vec_id"),
        (-F.col("found.less")).alias("score"),
    )
