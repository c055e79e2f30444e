"""Dates that arrive as text, and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partial_date(c: Column) -> Column:
    """Date from day-precision text, else from month-precision text (first of month), else NULL.

    Plain text of either form takes a cast, much cheaper than a format; a failed format is the
    dearest of all, so text too short for both is not tried. The result is that of trying the day
    format and then the month format.
    """
    by_format = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyy-MM"))
    plain = c.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?\z")
    return F.when(plain, c.try_cast("date")).when(F.length(c) >= 7, by_format)


def date_precision(c: Column) -> Column:
    """'month' for seven-character text, 'day' for any other text, NULL for NULL.

    It describes the text, not the parse: a bare year is 'day' although its date is NULL.
    """
    return F.when(F.length(c) == 7, "month").when(c.isNotNull(), "day")


def compact_date(c: Column) -> Column:
    """Date from yyyyMMdd text. Any other text gives NULL, for a not_null check to report."""
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(r"^[0-9]{8}\z"), dashed.try_cast("date")).otherwise(F.try_to_date(c, "yyyyMMdd"))


def pulled_at(c: Column) -> Column:
    """Timestamp from ISO-8601 text with an offset."""
    return c.cast("timestamp")


def date_key(c: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(c) * 10_000 + F.month(c) * 100 + F.dayofmonth(c)


def calendar_columns(c: Column) -> list[Column]:
    """Calendar attributes of a date; day_of_week counts from Sunday = 1."""
    day_of_week = F.dayofweek(c)
    return [
        date_key(c).alias("date_key"),
        c.alias("date_day"),
        F.year(c).alias("year_number"),
        F.quarter(c).alias("quarter_of_year"),
        F.month(c).alias("month_of_year"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string")).alias("year_quarter"),
        day_of_week.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name"),
        day_of_week.isin(1, 7).alias("is_weekend"),
    ]
