"""Time cuts, calendar features and dates held in text."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month and day of the holidays that the models know.
HOLIDAYS = ("01-01", "07-04", "12-25")


def time_bucket(seconds: Column | str, grain: str = "hour") -> Column:
    """Unix seconds cut to the grain (in the session zone, pinned to UTC)."""
    return F.date_trunc(grain, F.timestamp_seconds(seconds))


def holiday_columns(ts: Column, holidays: list[str]) -> Column:
    return F.date_format(ts, "MM-dd").isin(*holidays) if holidays else F.lit(False)


def calendar_features(df: DataFrame, ts: str, holidays: list[str] = HOLIDAYS) -> DataFrame:
    """Unix time, weekend and holiday flags, hour, and the hour's place on the day, week, month and year circle."""
    t = F.col(ts)
    hour = F.hour(t)
    places = {
        "day": (hour, F.lit(24)),
        "week": (F.weekday(t) * 24 + hour, F.lit(168)),
        "month": ((F.dayofmonth(t) - 1) * 24 + hour, F.dayofmonth(F.last_day(t)) * 24),
        "year": ((F.dayofyear(t) - 1) * 24 + hour, F.dayofyear(F.make_date(F.year(t), F.lit(12), F.lit(31))) * 24),
    }
    added = {
        "unix_ts": F.unix_timestamp(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
        "is_holiday": holiday_columns(t, list(holidays)).cast("int"),
        "hour_of_day": hour,
    }
    for name, (position, period) in places.items():
        angle = F.lit(2 * math.pi) * position / period
        added[f"sin_{name}"] = F.sin(angle)
        added[f"cos_{name}"] = F.cos(angle)
    return df.withColumns(added)


def stamp_in_name(name: Column | str) -> Column:
    """The 'yyyy-MM-dd_HH:mm:ss' stamp inside a name as a timestamp, null when there is none."""
    # Fixed value: the stamp's format in run names.
    stamp = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2})", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyy-MM-dd_HH:mm:ss"))


def retention_day(day: Column, days: int = 90) -> Column:
    """The day `days` later, as yyyyMMdd text."""
    return F.date_format(F.date_add(day, days), "yyyyMMdd")
