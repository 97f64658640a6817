"""Calendar and elapsed-time expressions.

Elapsed times rely on a UTC session zone (``tradewind.session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.text import as_column

# First month of the fiscal year; ISO weekday numbers of a weekend.
FISCAL_START_MONTH = 7
WEEKEND_DAYS = [6, 7]


def date_key(c: Column | str) -> Column:
    """Date to integer YYYYMMDD; NULL stays NULL."""
    d = as_column(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(c: Column | str) -> Column:
    """Date to integer YYYYMM."""
    d = as_column(c).cast("date")
    return (F.year(d) * 100 + F.month(d)).cast("int")


def iso_day_of_week(c: Column | str) -> Column:
    """Monday = 1 … Sunday = 7."""
    return (F.weekday(as_column(c)) + 1).cast("int")


def calendar_parts(c: Column | str) -> dict[str, Column]:
    d = as_column(c)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": iso_day_of_week(d),
        "week_of_year": F.weekofyear(d),
    }


def calendar_names(c: Column | str) -> dict[str, Column]:
    d = as_column(c)
    return {"month_name": F.date_format(d, "MMMM"), "day_name": F.date_format(d, "EEEE")}


def is_weekend(c: Column | str) -> Column:
    return iso_day_of_week(c).isin(WEEKEND_DAYS)


def fiscal_year(c: Column | str) -> Column:
    """The year turns in July; the fiscal quarter (below) does not."""
    d = as_column(c)
    return F.when(F.month(d) >= FISCAL_START_MONTH, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(c: Column | str) -> Column:
    return F.quarter(as_column(c))


def month_label(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM``."""
    return F.concat(as_column(year).cast("string"), F.lit("-"), F.lpad(as_column(month).cast("string"), 2, "0"))


def elapsed_seconds(end: Column | str, start: Column | str) -> Column:
    return F.timestamp_diff("SECOND", as_column(start), as_column(end))


def elapsed_hours(end: Column | str, start: Column | str, mode: str = "truncate") -> Column:
    """Whole hours between two times; a missing end counts as 0.

    ``truncate`` cuts towards zero, ``floor`` rounds down.
    """
    hours = elapsed_seconds(end, start) / 3600
    whole = hours.cast("int") if mode == "truncate" else F.floor(hours).cast("int")
    return F.coalesce(whole, F.lit(0))


def elapsed_days(end: Column | str, start: Column | str, mode: str = "floor") -> Column:
    """Whole days between two times; a missing end counts as 0.

    ``floor`` rounds elapsed 24-hour periods down, ``calendar`` subtracts dates.
    """
    if mode == "floor":
        days = F.floor(elapsed_seconds(end, start) / 86400).cast("int")
    else:
        days = F.datediff(as_column(end).cast("date"), as_column(start).cast("date"))
    return F.coalesce(days, F.lit(0))


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))
