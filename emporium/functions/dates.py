"""Calendar expressions: date keys and the date-dimension attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column | str) -> Column:
    """Integer yyyyMMdd key of a timestamp/date (null stays null)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyyMMdd").cast("int")


def month_key(ts: Column | str) -> Column:
    """Integer yyyyMM key; the partition column of the order fact."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyyMM").cast("int")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end (works on TIMESTAMP and TIMESTAMP_NTZ)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", s, e)


def calendar_columns(d: Column) -> list[Column]:
    """The 18 date-dimension columns for a DATE column ``d``.

    Day of week is 1 = Sunday ... 7 = Saturday.
    """
    dow = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short"),
        dow.isin(1, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.dayofyear(d).alias("day_of_year"),
        (d == F.last_day(d)).alias("is_month_end"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
    ]
