"""Date helpers: day counts, date keys (U1), calendar generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """DATE(ts): timestamps (incl. timestamp_ntz) -> date."""
    return F.to_date(_c(c))


def days_between(start: Column | str, end: Column | str, floor: int | None = None) -> Column:
    """DATEDIFF(end, start) in days, optionally floored (F3 floors at 1)."""
    d = F.datediff(_c(end), _c(start))
    return F.greatest(d, F.lit(floor)) if floor is not None else d


def date_key(c: Column | str) -> Column:
    """U1 without a lookup: yyyymmdd integer of a date (the calendar's key rule)."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_of(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def month_name(c: Column | str) -> Column:
    """MONTHNAME: full English month name ('January')."""
    return F.date_format(_c(c), "MMMM")


# The reference calendar range.
CALENDAR_START = dt.date(2015, 1, 1)
CALENDAR_END = dt.date(2035, 12, 31)


def calendar(spark: SparkSession, start: dt.date = CALENDAR_START,
             end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end]: (sk_tempo int yyyymmdd, data date).

    Generated with ``range`` over the day offsets, so the rows are produced in
    parallel and no recursion or driver-side list is involved.
    """
    n = (end - start).days + 1
    return (spark.range(0, n, numPartitions=max(1, min(8, n // 4096 + 1)))
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("data"))
            .select(date_key("data").alias("sk_tempo"), "data"))
