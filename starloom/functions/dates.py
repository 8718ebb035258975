"""Date keys and the date-dimension attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import _col


def date_key(ts: Column | str) -> Column:
    """Smart key ``YYYYMMDD`` as int; null stays null."""
    t = _col(ts)
    return F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)


def dim_date_columns(day: Column | str) -> list[Column]:
    """The seven ``dim_date`` columns for a date column (weekday names are English)."""
    d = _col(day)
    return [
        date_key(d).alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("weekday"),
    ]
