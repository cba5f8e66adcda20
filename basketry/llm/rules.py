"""Quality rules with thresholds learned per language and source.

``measure`` counts what the rules look at, with Spark's own functions on whole texts. For
each language and source the shares of marks, symbols, repeated lines and repeated words and
the mean word length go into quantile sketches (KLL), which are built per task and merged.
A threshold is the median plus ``SPREADS`` times the distance of a low quantile below it
(or of a least distance, for measures that hardly vary), so it follows what is usual in the
group and is not moved by a minority of junk; it rejects outliers and no fixed share. The
threshold of a group of n documents counts n / (n + ``HALF_AT``), the rest that of its language
from merged sketches, which is weighed against that of all documents in the same way. So
a small group leans on a larger one, and no number of documents changes a verdict at a stroke.
The thresholds are joined back to the documents.

Cases: a null or empty text has counts of 0 and fails for its length; null languages and
sources are groups of their own; repeated rows are judged alike; an empty table gives an
empty result; further columns are kept (those named like an added one are replaced). Sketches
are of bounded error, so a document right at a threshold may be judged otherwise in a rerun.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.scratch import stored
from basketry.operators.lookup import lookup_join

#: ASCII white space, as characters and for patterns.
WHITE_CHARS = " \t\n\x0b\f\r"
WHITE = " \\x09-\\x0D"

#: Size of a sketch; its quantiles are off by about 0.4 % of the ranks.
SKETCH_SIZE = 800
#: Documents of a group at which its own quantiles count for half.
HALF_AT = 20
LOW_QUANTILE = 0.05
SPREADS = 8

#: Least distance between the median and the low quantile of each measure.
LEAST = {
    "marks": 0.01,
    "symbols": 0.005,
    "dup_lines": 0.075,
    "repeats": 0.05,
    "word_length": 1.0,
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of three that stand twice or more in the text."""
    windows = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - 3),
        lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)),
    )

    def covered(values: Column) -> Column:
        placed = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        again = _let(
            placed,
            lambda p: F.filter(
                p,
                lambda x, j: (
                    (F.coalesce(F.get(p, j - 1)["v"] == x["v"], F.lit(False)))
                    | (F.coalesce(F.get(p, j + 1)["v"] == x["v"], F.lit(False)))
                ),
            ),
        )
        starts = F.array_sort(F.transform(again, lambda x: x["i"]))
        step = lambda s: F.aggregate(
            F.sequence(F.lit(1), F.size(s) - 1),
            F.lit(3),
            lambda n, j: n + F.least(F.lit(3), F.get(s, j) - F.get(s, j - 1)),
        )
        return _let(starts, lambda s: F.when(F.size(s) > 1, step(s)).otherwise(0))

    counted = lambda v: F.when(F.size(F.array_distinct(v)) < F.size(v), covered(v)).otherwise(0)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, 0).otherwise(_let(_let(hashed, windows), counted))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS``, n_lines, n_marks and base_failed."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(WHITE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{WHITE}]+")
    )
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(WHITE_CHARS)) != "")
    of_words = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    added = [*COUNTS, "n_lines", "n_marks", "base_failed"]
    kept = [c for c in docs.columns if c not in added]
    counted = docs.select(
        *kept,
        of_words.alias("__words"),
        of_lines.alias("__lines"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit("[\\p{P}\\p{S}]")).cast("long").alias("n_marks"),
    )
    n_words, repeats = F.col("__words.n_words"), F.col("__words.n_repeat_words")
    return counted.select(
        *kept, "__words.*", "__lines.*", "n_symbols", "n_marks",
        ((n_words < 50) | (100 * repeats > 50 * n_words)).alias("base_failed"),
    )


def _measures() -> dict[str, Column]:
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return {
        "marks": share("n_marks", "word_chars"),
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def _group(lang: Column, source: Column) -> Column:
    """A key that is never null; the length keeps the two parts apart."""
    part = lambda c: F.when(c.isNull(), "n").otherwise(F.concat(F.length(c), F.lit("s"), c))
    return F.concat(part(lang), F.lit("/"), part(source))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Highest value of each measure for every language and source: key, max_<measure>."""
    names = list(LEAST)
    judged = measured.where(~F.col("base_failed"))
    rows = judged.select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), *(c.cast("double").alias(n) for n, c in _measures().items())
    )
    sketches = rows.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *(F.kll_sketch_agg_double(n, F.lit(SKETCH_SIZE)).alias(n) for n in names)
    )
    sketches = stored(sketches, "sketches")

    def merged(by: list[str], suffix: str) -> DataFrame:
        return sketches.groupBy(*by).agg(
            F.sum("n").alias(f"n{suffix}"),
            *(F.kll_merge_agg_double(n, F.lit(SKETCH_SIZE)).alias(f"{n}{suffix}") for n in names),
        )

    languages = merged(["lang"], "_lang")
    languages = languages.select(F.col("lang").alias("lang_of"), *[c for c in languages.columns if c != "lang"])
    # One row per language, and one of all documents, meet one row per group.
    levels = sketches.join(languages, F.col("lang").eqNullSafe(F.col("lang_of"))).withColumn("one", F.lit(1))
    levels = levels.join(merged([], "_all").withColumn("one", F.lit(1)), "one")

    def limit(sketch: str, least: float) -> Column:
        at = lambda q: F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(q))
        return at(0.5) + SPREADS * F.greatest(at(0.5) - at(LOW_QUANTILE), F.lit(least))

    def weighed(count: str, own: Column, other: Column) -> Column:
        share = F.col(count) / (F.col(count) + HALF_AT)
        return share * own + (1 - share) * other

    def highest(name: str) -> Column:
        of_lang, of_all = limit(f"{name}_lang", LEAST[name]), limit(f"{name}_all", LEAST[name])
        larger = weighed("n_lang", of_lang, of_all)
        return weighed("n", limit(name, LEAST[name]), larger).alias(f"max_{name}")

    return levels.select(_group(F.col("lang"), F.col("source")).alias("key"), *(highest(n) for n in names))


def judged(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``kept``: no base rule failed and no measure above its threshold."""
    key = _group(F.col(lang), F.col(source))
    limits = limits.select(*(F.col(c).alias(f"__{c}") for c in limits.columns))
    columns = [c for c in measured.columns if c != "kept"]
    joined = lookup_join(measured.withColumn("__key", key), limits, ["__key"])
    fine = F.lit(True)
    for name, value in _measures().items():
        fine = fine & F.coalesce(value <= F.col(f"__max_{name}"), F.lit(True))
    return joined.select(*columns, (~F.col("base_failed") & fine).alias("kept"))


def verdicts(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and verdict of every document, without its text; texts are read once."""
    rows = measure(docs.select(doc_id, "text", "lang", "source")).drop("text")
    rows = stored(rows, "measured")
    return judged(rows, stored(thresholds(rows), "thresholds"))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all their columns as they were."""
    names = docs.columns
    boxed = docs.select(F.struct(*names).alias("__row"), "text", "lang", "source")
    rows = measure(boxed)
    limits = stored(thresholds(rows.drop("__row")), "thresholds")
    return judged(rows, limits).where("kept").select("__row.*")
