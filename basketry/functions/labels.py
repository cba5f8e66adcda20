"""Readable names for coded values."""

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels the reports show.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
SUNDAY_FIRST = {(number + 1) % 7: name for number, name in enumerate(WEEKDAYS)}
MONTH_NAMES = dict(enumerate(MONTHS, start=1))
PERISHABLE = {0: "Non-Perishable", 1: "Perishable"}
PROMOTION_STATUS = {True: "With Promotion", False: "Without Promotion"}
PROMOTION_SHORT = {True: "With Promotion", False: "No Promotion"}
DAY_KIND = {True: "Holidays", False: "Regular Days"}


def label(column: Column, names: Mapping[Any, str]) -> Column:
    """Name of each value; values without a name, and NULL, stay NULL."""
    (first, name), *rest = names.items()
    labelled = F.when(column == first, name)
    for value, name in rest:
        labelled = labelled.when(column == value, name)
    return labelled


def title(column: Column) -> Column:
    """``item_family`` reads ``Item Family``."""
    return F.initcap(F.replace(column, F.lit("_"), F.lit(" ")))
