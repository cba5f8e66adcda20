"""Date parts and calendar flags."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_of_week(date: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(date) - 1


def is_payday(date: Column) -> Column:
    """Wages are paid on the 15th and on the last day of the month."""
    return (F.dayofmonth(date) == 15) | (date == F.last_day(date))


def add_calendar(frame: DataFrame, column: str = "date") -> DataFrame:
    date = F.col(column)
    day = F.dayofmonth(date)
    # A missing date makes each comparison NULL; the flags then read FALSE.
    yes = {
        "is_weekend": day_of_week(date).isin(0, 6),
        "is_payday": is_payday(date),
        "is_month_start": day <= 7,
        "is_month_end": day >= 24,
    }
    return frame.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "week_of_year": F.weekofyear(date),
            "day_of_month": day,
            "day_of_week": day_of_week(date),
            **{name: F.coalesce(test, F.lit(False)) for name, test in yes.items()},
        }
    )


def add_day_names(frame: DataFrame, column: str = "date") -> DataFrame:
    """Year, month, weekday (0 is Monday), full English weekday name and ISO week."""
    date = F.col(column)
    return frame.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day_of_week": F.weekday(date),
            "day_name": F.date_format(date, "EEEE"),
            "week_of_year": F.weekofyear(date),
        }
    )


def year_month(year: Column, month: Column) -> Column:
    months = F.lpad(month.cast("int").cast("string"), 2, "0")
    return F.concat(year.cast("int").cast("string"), F.lit("-"), months)


def daily_calendar(frame: DataFrame, column: str = "date") -> DataFrame:
    """One row per day from the first to the last date of ``frame``; none for no dates."""
    span = frame.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return span.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias(column))
