"""Date expressions over split year, month and day integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_length(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return (
        F.when(month == 2, F.when(leap, 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )


def is_calendar_date(year: Column, month: Column, day: Column) -> Column:
    good = month.between(1, 12) & day.between(1, month_length(year, month))
    return F.coalesce(good, F.lit(False))


def has_zero_part(year: Column, month: Column, day: Column) -> Column:
    return F.coalesce((year == 0) | (month == 0) | (day == 0), F.lit(False))


def date_of(year: Column, month: Column, day: Column) -> Column:
    """The date, NULL when the parts are none."""
    return F.when(is_calendar_date(year, month, day), F.make_date(year, month, day))


def quarter_of(month: Column) -> Column:
    return (F.floor((month - 1) / 3) + 1).cast("int")


def weekday_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "EEEE"), F.lit("unknown"))


GRAINS = {"Year": "year", "Month": "month", "Date": "day"}


def truncated(date: Column, grain: str) -> Column:
    """The date cut to the grain a user picked: Year, Month or Date."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {list(GRAINS)}")
    return F.date_trunc(GRAINS[grain], date)
