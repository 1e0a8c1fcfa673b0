"""Calendar columns and date ranges."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(df: DataFrame, *parts: str, date: str = "Date") -> DataFrame:
    """Add ``Year``, ``Month``, ``Day`` and ISO ``Week`` (or the named ones)."""
    makers = {
        "Year": F.year,
        "Month": F.month,
        "Day": F.dayofmonth,
        "Week": F.weekofyear,
    }
    wanted = parts or tuple(makers)
    return df.withColumns({part: makers[part](date) for part in wanted})


def in_months(date: Column, first: int, last: int) -> Column:
    return F.month(date).between(first, last)


def month_ranges(date: Column, first: int, last: int, years: tuple[int, int]) -> Column:
    """The same test as ``in_months`` for known years, as plain date comparisons.

    ``month(date)`` cannot be pushed into Parquet; comparisons with literals can.
    """
    spans = []
    for year in range(years[0], years[1] + 1):
        stop = dt.date(year + 1, 1, 1) if last == 12 else dt.date(year, last + 1, 1)
        spans.append(
            (date >= F.lit(dt.date(year, first, 1))) & (date < F.lit(stop))
        )
    return reduce(lambda left, right: left | right, spans)


def last_day_of_year(date: Column) -> Column:
    return F.make_date(F.year(date), F.lit(12), F.lit(31))


def dates_after(start: Column, stop: Column) -> Column:
    """Array of the days after ``start`` up to ``stop``; empty when there are none.

    ``sequence`` counts down when its start lies behind its stop, hence the guard.
    """
    return F.when(
        start < stop, F.sequence(F.date_add(start, 1), stop)
    ).otherwise(F.array().cast("array<date>"))
