"""Exact distinct counts by bitmaps that merge.

A whole number (or a day) is a bit in the word of 64 it falls into. Grouping by the key and the word
keeps at most one row of eight bytes for every 64 neighbouring values, in a hash aggregate whose
partial results merge by OR; no row of the input is repeated and no pair of values is shuffled.
Words of one key spread over tasks, so a hot key is not one task's work.

NULL is not counted. A NULL key is a group like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = 6  # of a place in a word


def _number(frame: DataFrame, column: str) -> Column:
    if isinstance(frame.schema[column].dataType, T.DateType):
        return F.unix_date(column)
    return F.col(column)


def _word(number: Column) -> Column:
    return F.shiftright(number, _BITS)


def _mask(number: Column) -> Column:
    place = number.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place))


def _total(masks: str) -> Column:
    return F.coalesce(F.sum(F.bit_count(masks)), F.lit(0))


def counts_by_key(
    frame: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, Column]
) -> DataFrame:
    """One row per key: the additive aggregates in ``sums`` (sums and counts) and, for each name
    in ``distinct``, the distinct values of that column.

    Each counted column is one pass over it and the keys; the first carries the sums.
    """
    keys = list(keys)
    parts = []
    for name, column in distinct.items():
        number = _number(frame, column)
        carried = {} if parts else sums
        words = frame.groupBy(*keys, _word(number).alias("__word")).agg(
            _mask(number).alias("__mask"), *(each.alias(each_name) for each_name, each in carried.items())
        )
        merged = [F.sum(each_name).alias(each_name) for each_name in carried]
        parts.append(words.groupBy(*keys).agg(*merged, _total("__mask").alias(name)))
    first, *rest = parts
    for part in rest:
        renamed = part.withColumnsRenamed({key: f"__{key}" for key in keys})
        same = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys]
        first = first.join(renamed, reduce(Column.__and__, same)).drop(*(f"__{key}" for key in keys))
    return first


def counts_of_all(
    frame: DataFrame,
    distinct: Mapping[str, str],
    merged: Mapping[str, tuple[Column, Column]],
    few: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row for the whole input, in one pass over it.

    Rows are grouped by the words of all counted columns at once, some 4,000 times fewer
    groups than pairs of values for two columns. ``merged`` names aggregates with the one
    of each group and the one that merges groups, which refers to it by name. ``few`` is
    like ``distinct``, for columns of any type with few values: rows are grouped by each of them too.
    """
    few = dict(few or {})
    numbers = {name: _number(frame, column) for name, column in distinct.items()}
    words = {f"__word_{name}": _word(number) for name, number in numbers.items()}
    values = {f"__few_{name}": F.col(column).cast("string") for name, column in few.items()}
    keyed = frame.withColumns({**words, **values})
    sets = [list(words), *([name] for name in values)]
    grouped = keyed.groupingSets(sets, *words, *values) if few else keyed.groupBy(*words)
    cells = grouped.agg(
        *(_mask(number).alias(f"__mask_{name}") for name, number in numbers.items()),
        *(partial.alias(name) for name, (partial, _) in merged.items()),
        *(F.grouping(name).alias(f"__all{name}") for name in values),
    )
    # A cell's masks, each once with its word; the aggregates go with the first of them.
    entries = [
        F.struct(
            F.lit(place).alias("kind"),
            F.col(f"__word_{name}").cast("long").alias("word"),
            F.lit(None).cast("string").alias("value"),
            F.col(f"__mask_{name}").alias("mask"),
            *((F.col(m) if place == 0 else F.lit(None)).alias(m) for m in merged),
        )
        for place, name in enumerate(distinct)
    ]
    listed = F.array(*entries)
    for place, name in enumerate(values, len(distinct)):
        entry = F.struct(
            F.lit(place).alias("kind"),
            F.lit(None).cast("long").alias("word"),
            F.col(name).alias("value"),
            F.lit(None).cast("long").alias("mask"),
            *(F.lit(None).alias(m) for m in merged),
        )
        listed = F.when(F.col(f"__all{name}") == 0, F.array(entry)).otherwise(listed)
    by_word = cells.select(F.inline(listed)).groupBy("kind", "word", "value").agg(
        F.bit_or("mask").alias("mask"), *(merge.alias(name) for name, (_, merge) in merged.items())
    )
    counted = [
        F.coalesce(F.sum(F.when(F.col("kind") == place, F.bit_count("mask"))), F.lit(0)).alias(name)
        for place, name in enumerate(distinct)
    ]
    counted += [
        F.count(F.when(F.col("kind") == place, F.col("value"))).alias(name)
        for place, name in enumerate(few, len(distinct))
    ]
    return by_word.agg(*counted, *(merge.alias(name) for name, (_, merge) in merged.items()))
