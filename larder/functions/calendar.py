"""Parts of a moment, and windows that look back from a run date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Year, month, day, time of day (as text) and date of a column of whole seconds."""
    moment = F.col(ts)
    return df.select(
        moment.alias("ts"),
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.dayofmonth(moment).alias("day"),
        F.substring(moment.cast("string"), 12, 8).alias("time"),
        F.to_date(moment).alias("date"),
    )


def second_number(moment: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone."""
    days = F.date_diff(F.to_date(moment), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def lookback_bounds(run_date: dt.date, days: int = 7) -> tuple[Column, Column]:
    """Midnight ``days`` before the run date, and midnight of the run date."""
    start = dt.datetime.combine(run_date - dt.timedelta(days=days), dt.time())
    end = dt.datetime.combine(run_date, dt.time())
    return (
        F.lit(start.isoformat(" ")).cast("timestamp_ntz"),
        F.lit(end.isoformat(" ")).cast("timestamp_ntz"),
    )
