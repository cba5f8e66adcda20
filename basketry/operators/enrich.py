"""The wide sales table: stores, items, oil price, holidays and calendar."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.calendar import add_calendar
from basketry.operators.lookup import Lookup, lookup_join


def _joined(
    sales: DataFrame, lookup: Lookup, keys: list[str], keys_from: DataFrame | None
) -> DataFrame:
    row_id = [name for name in ("id",) if name in sales.columns]
    return lookup_join(sales, lookup, keys, keys_from=keys_from, row_id=row_id)


def join_stores(
    sales: DataFrame, stores: Lookup, keys_from: DataFrame | None = None
) -> DataFrame:
    columns = stores.frame.select(
        "store_nbr",
        "city",
        "state",
        F.col("type").alias("store_type"),
        F.col("cluster").alias("store_cluster"),
    )
    return _joined(sales, stores.derive(columns), ["store_nbr"], keys_from)


def join_items(
    sales: DataFrame, items: Lookup, keys_from: DataFrame | None = None
) -> DataFrame:
    columns = items.frame.select(
        "item_nbr",
        F.col("family").alias("item_family"),
        F.col("class").alias("item_class"),
        "perishable",
    )
    return _joined(sales, items.derive(columns), ["item_nbr"], keys_from)


def join_oil(
    sales: DataFrame, oil_clean: Lookup, keys_from: DataFrame | None = None
) -> DataFrame:
    columns = oil_clean.frame.select(
        "date", "oil_price", F.col("is_imputed").alias("oil_is_imputed")
    )
    return _joined(sales, oil_clean.derive(columns), ["date"], keys_from)


#: Kinds of holidays: their locale, and the column of a sale's place they are matched by.
_KINDS = {
    "_national": ("National", {}),
    "_regional": ("Regional", {"state": "locale_name"}),
    "_local": ("Local", {"city": "locale_name"}),
}

#: Lookups of the three kinds, as ``holiday_events`` makes them.
HolidayEvents = dict[str, Lookup]


def holiday_events(
    holidays_clean: Lookup | DataFrame,
    store: Callable[[str, DataFrame], DataFrame] = lambda name, frame: frame,
) -> HolidayEvents:
    """The events of each key as a list, a lookup per kind of holiday.

    ``store`` may write a lookup under a name and return it read back; the size of each is
    measured here, once, however many plans then join to it.
    """
    whole = holidays_clean if isinstance(holidays_clean, Lookup) else Lookup.of(holidays_clean)
    return {
        name: whole.measure(store(f"events{name}", _events(whole.frame, locale, place, name)))
        for name, (locale, place) in _KINDS.items()
    }


def join_holidays(
    sales: DataFrame,
    holidays: HolidayEvents | Lookup | DataFrame,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add the holidays in force at each sale's place; ``sales`` and ``keys_from`` need
    date, city and state.

    National holidays match by date, regional ones by date and state, local ones by
    date and city. Each kind is one lookup by equal keys, holding the events of a key
    as a list, and the lists are then unfolded: a sale with several holidays on its
    day appears once per holiday, a sale with none appears once.
    """
    lookups = holidays if isinstance(holidays, dict) else holiday_events(holidays)
    joined = sales
    for events, lookup in lookups.items():
        keys = ["date", *_KINDS[events][1]]
        joined = _joined(joined, lookup, keys, sales if keys_from is None else keys_from)
    some = F.coalesce(*lookups).isNotNull()
    matched = F.when(some, F.concat(*[_or_empty(events) for events in lookups]))
    return joined.select(*sales.columns, F.inline_outer(matched)).withColumn(
        "is_holiday", F.coalesce("is_holiday", F.lit(False))
    )


def _events(holidays: DataFrame, locale: str, place: dict[str, str], name: str) -> DataFrame:
    event = F.struct(
        F.col("type").alias("holiday_type"),
        F.col("description").alias("holiday_description"),
        F.lit(True).alias("is_holiday"),
    )
    keys = [F.col("date"), *[F.col(source).alias(key) for key, source in place.items()]]
    return (
        holidays.where(F.col("locale") == locale)
        .groupBy(*keys)
        .agg(F.collect_list(event).alias(name))
    )


def _or_empty(events: str) -> Column:
    kind = "array<struct<holiday_type:string,holiday_description:string,is_holiday:boolean>>"
    return F.coalesce(F.col(events), F.array().cast(kind))


def master(
    sales: DataFrame,
    stores: Lookup | DataFrame,
    items: Lookup | DataFrame,
    oil_clean: Lookup | DataFrame,
    holidays_clean: HolidayEvents | Lookup | DataFrame,
    gather: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """All sales rows with their attributes, holidays and calendar features.

    With lookups small enough to broadcast this is one pass over the sales without
    a shuffle. Lookups too large for that are joined first, while rows are narrow.

    ``gather`` may bring rows together by columns of ``sales``. It gets them before the
    broadcast joins, so that wide rows are not shuffled.
    """
    joins = [
        (join, each if isinstance(each, Lookup) else Lookup.of(each))
        for join, each in ((join_stores, stores), (join_items, items), (join_oil, oil_clean))
    ]
    events = holidays_clean if isinstance(holidays_clean, dict) else holiday_events(holidays_clean)
    early = all(each.small for each in events.values())
    wide = sales
    for join, lookup in joins:
        wide = wide if lookup.small else join(wide, lookup, keys_from=sales)
    wide = gather(wide) if early else wide
    for join, lookup in joins:
        wide = join(wide, lookup, keys_from=sales) if lookup.small else wide
    placed = sales if early else join_stores(sales, joins[0][1])
    wide = join_holidays(wide, events, keys_from=placed)
    wide = wide if early else gather(wide)
    return add_calendar(wide).select(*schemas.MASTER.names)
