"""Mixing sources to target weights by capped water-filling, and the sample it asks for.

Every source has a weight. Together they share a budget of words by weight, but no source
gives more than ``max_epochs`` times its words: what is over is shared again by weight until
no source is above. The level at which that settles is found directly: in ascending order of
cap over weight, the first sources are at their cap and the rest share what is left.

A source's documents are then taken a whole number of times, and the rest of its target from
a seeded order of its documents: hash buckets are taken whole until the target is met, then
documents of the last bucket in the order of a second hash, and of the one document at which
the target is met a fraction of the words (of equal rows each the same). Sizes are summed per source and
bucket before anything meets, so a source with a third of all rows is no single task, and
the table of sources is joined by broadcast only after its size is measured.

Cases: a null or empty text has size 0 and is taken 0 times; a null source is a source of its
own and comes last; a source without words has the target 0; repeated rows are each taken
alike; an empty table gives an empty result; further columns are kept
(those named like an added one are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.scratch import stored
from basketry.operators.lookup import lookup_join

#: Parts of each source's seeded order.
BUCKETS = 1024

#: Space and the ASCII controls from tab to carriage return.
WHITE = " \\x09-\\x0D"


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; 0 for a null text."""
    parts = F.size(F.split(text, f"[{WHITE}]+"))
    opens = F.when(F.regexp_like(text, F.lit(f"^[{WHITE}]")), 1).otherwise(0)
    closes = F.when(F.regexp_like(text, F.lit(f"[{WHITE}]$")), 1).otherwise(0)
    # An empty text, or one of white space alone, splits into one or two empty parts.
    blank = ~F.regexp_like(text, F.lit(f"[^{WHITE}]"))
    return F.when(text.isNull() | blank, 0).otherwise(parts - opens - closes).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null and keeps null apart from every text."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))


def targets(
    sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float
) -> DataFrame:
    """``sizes`` (key, source, source_size, one row per source) with the target of each.

    Sources in code point order, null last, have the weights in turn. The windows run over
    one row per source.
    """
    listed = F.array(*(F.lit(float(w)) for w in weights))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.get(listed, turn))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    ascending = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share - capped).alias("budget"),
        (F.sum("weight").over(everything) - used).alias("left_weight"),
    )
    # The level if this source and all later ones share what is left; the first source whose
    # cap is not below it settles the level for itself and all later ones.
    level = F.col("budget") / F.col("left_weight")
    fits = F.when(F.col("cap") >= level * F.col("weight"), level)
    settled = left.withColumn("level", F.min_by(fits, F.when(fits.isNotNull(), F.col("cap") / F.col("weight"))).over(everything))
    target = F.least("cap", F.coalesce("level", F.lit(float("inf"))) * F.col("weight"))
    return settled.select("key", "source_size", F.when(F.col("cap") == 0, 0.0).otherwise(target).alias("target"))


def plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 11,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with size, source_size, target, epochs (whole repetitions) and taken (words)."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(BUCKETS)).cast("int")
    added = {"__key": source_key(F.col(source)), "__size": word_count(F.col(text)), "__bucket": bucket}
    sized = docs.select("*", *(c.alias(n) for n, c in added.items()))
    sums = stored(
        sized.groupBy("__key", "__bucket")
        .agg(F.min(F.col(source)).alias("source"), F.sum("__size").alias("words"))
        .select(F.col("__key").alias("key"), "source", F.col("__bucket").alias("bucket"), "words"),
        "source-words",
    )
    sizes = sums.groupBy("key").agg(F.min("source").alias("source"), F.sum("words").alias("source_size"))
    aims = targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.select("*", whole.alias("epochs"))
    aims = aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    order = Window.partitionBy("key").orderBy("bucket")
    after = F.sum("words").over(order)
    cuts = (
        sums.select("key", "bucket", "words", (after - F.col("words")).alias("before"))
        .join(aims.select("key", "rest"), "key")
        .where((F.col("before") < F.col("rest")) & (F.col("words") > 0))
        .groupBy("key")
        .agg(
            F.max("bucket").alias("cut"),
            F.max_by(F.col("rest") - F.col("before"), "bucket").alias("open"),
        )
    )
    table = aims.drop("rest").join(cuts, "key", "left")
    names = ["source_size", "target", "epochs", "cut", "open"]
    table = stored(table.select(F.col("key").alias("__key"), *(F.col(n).alias(f"__{n}") for n in names)), "targets")
    # Rows without an id, or with the same one, are told apart by their texts.
    place = F.struct(
        F.xxhash64(F.lit(seed + 1), F.col(doc_id)).alias("id"), F.xxhash64(F.lit(seed + 1), F.col(text)).alias("text")
    )
    last = docs.select(added["__key"].alias("__key"), bucket.alias("__bucket"), place.alias("__place"), F.col(text).alias("__text"))
    last = lookup_join(last, table.select("__key", "__cut", "__open"), ["__key"])
    last = last.where(F.col("__bucket") == F.col("__cut"))
    last = last.select("__key", "__open", "__place", word_count(F.col("__text")).alias("__words"))
    last = last.groupBy("__key", "__place").agg(F.sum("__words").alias("__words"), F.first("__open").alias("__open"))
    until = F.sum("__words").over(Window.partitionBy("__key").orderBy("__place"))
    last = last.withColumn("__left", F.col("__open") - (until - F.col("__words")))
    last = last.where((F.col("__left") > 0) & (F.col("__words") > 0)).groupBy("__key").agg(
        F.max("__place").alias("__end"),
        F.max_by(F.least(F.col("__left") / F.col("__words"), F.lit(1.0)), "__place").alias("__part"),
    )
    table = stored(table.drop("__open").join(last, "__key", "left"), "cuts")
    joined = lookup_join(sized.withColumn("__place", place), table, ["__key"])
    on_cut = F.col("__bucket") == F.col("__cut")
    fraction = (
        F.when(F.col("__bucket") < F.col("__cut"), 1.0)
        .when(on_cut & (F.col("__place") < F.col("__end")), 1.0)
        .when(on_cut & (F.col("__place") == F.col("__end")), F.col("__part"))
        .otherwise(0.0)
    )
    extra = F.round(fraction * F.col("__size")).cast("long")
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "epochs", "taken")]
    return joined.select(
        *kept,
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__epochs").cast("long").alias("epochs"),
        (F.col("__epochs") * F.col("__size") + extra).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixture itself: each document as often as its plan says, the columns of ``docs``.

    The fractional repetition at which a source meets its target holds the first words of the
    text; one of no words is left out.
    """
    planned = plan(docs.select(*(F.col(c).alias(f"__doc_{c}") for c in docs.columns)), text=f"__doc_{text}", source="__doc_source", doc_id="__doc_doc_id", **options)
    rest = F.col("taken") - F.col("epochs") * F.col("size")
    times = F.col("epochs") + F.when(rest > 0, 1).otherwise(0)
    # Words with the white space before them, so that the first ones are a part of the text.
    body = F.col(f"__doc_{text}")
    words = F.regexp_extract_all(body, F.lit(f"([{WHITE}]*[^{WHITE}]+)"), 1)
    head = F.array_join(F.slice(words, 1, rest.cast("int")), "")
    cut = (F.col("__turn") > F.col("epochs")) & (rest < F.col("size"))
    each = planned.where(times > 0).withColumn("__turn", F.explode(F.sequence(F.lit(1), times)))
    each = each.withColumn(f"__doc_{text}", F.when(cut, head).otherwise(body))
    return each.select(*(F.col(f"__doc_{c}").alias(c) for c in docs.columns))
