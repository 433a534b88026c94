"""A holiday calendar made from rules, as a dimension to join by date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUNDAY = 6


@dataclass(frozen=True)
class Holiday:
    """A day of each year: a fixed day of a month, the n-th weekday of a month (from its end if negative; Monday is 0), or
    days after Easter Sunday."""

    name: str
    month: int = 0
    day: int = 0
    weekday: int = -1
    nth: int = 0
    after_easter: int | None = None

    def date(self, year: Column) -> Column:
        if self.after_easter is not None:
            return F.date_add(easter_sunday(year), self.after_easter)
        first = F.make_date(year, F.lit(self.month), F.lit(self.day or 1))
        if self.day:
            return first
        if self.nth > 0:
            return F.date_add(first, F.pmod(self.weekday - F.weekday(first), F.lit(7)) + 7 * (self.nth - 1))
        last = F.last_day(first)
        return F.date_sub(last, F.pmod(F.weekday(last) - self.weekday, F.lit(7)) + 7 * (-self.nth - 1))


# Public holidays of the United States with Good Friday, by their rules.
UNITED_STATES = (
    Holiday("New Year's Day", 1, 1),
    Holiday("Martin Luther King Day", 1, weekday=0, nth=3),
    Holiday("Washington's Birthday", 2, weekday=0, nth=3),
    Holiday("Good Friday", after_easter=-2),
    Holiday("Memorial Day", 5, weekday=0, nth=-1),
    Holiday("Independence Day", 7, 4),
    Holiday("Labor Day", 9, weekday=0, nth=1),
    Holiday("Columbus Day", 10, weekday=0, nth=2),
    Holiday("Veterans Day", 11, 11),
    Holiday("Thanksgiving", 11, weekday=3, nth=4),
    Holiday("Christmas Day", 12, 25),
)


def easter_sunday(year: Column) -> Column:
    """The Sunday after the first full moon of spring by the Gregorian church calendar."""
    golden, century = year % 19, F.floor(year / 100)
    # Days from 21 March to the full moon; the two last days of the lunar month are moved back.
    epact = (century - F.floor(century / 4) - F.floor((8 * century + 13) / 25) + 19 * golden + 15) % 30
    moon = epact - F.when((epact == 29) | ((epact == 28) & (golden > 10)), 1).otherwise(0)
    full = F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(21)), moon.cast("int"))
    return F.date_add(full, SUNDAY - F.weekday(full) + F.when(F.weekday(full) == SUNDAY, 7).otherwise(0))


def calendar(spark: SparkSession, first_year: int, last_year: int, rules: tuple[Holiday, ...] = UNITED_STATES) -> DataFrame:
    """day, holiday and observed (the Friday before a Saturday, the Monday after a Sunday): one row a rule and year."""
    year = F.col("id").cast("int")
    days = F.array(*[F.struct(F.lit(r.name).alias("holiday"), r.date(year).alias("day")) for r in rules])
    each = spark.range(first_year, last_year + 1).select(F.explode(days).alias("h")).select("h.day", "h.holiday")
    weekday = F.weekday("day")
    shift = F.when(weekday == SUNDAY - 1, -1).when(weekday == SUNDAY, 1).otherwise(0)
    return each.withColumn("observed", F.date_add("day", shift))


def with_holidays(df: DataFrame, day: Column, dates: DataFrame, observed: bool = False) -> DataFrame:
    """df with `holidays`, the names that a row's date has in order (empty: none), and is_holiday.

    The calendar has one row a date after grouping, a few a year, so the join is with a small dimension.
    """
    on = "observed" if observed else "day"
    named = dates.groupBy(F.col(on).alias("_day")).agg(F.array_sort(F.collect_set("holiday")).alias("holidays"))
    none = F.array().cast("array<string>")
    joined = df.withColumn("_date", day.cast("date")).join(named, F.col("_date") == F.col("_day"), "left")
    return joined.withColumn("holidays", F.coalesce("holidays", none)).withColumn("is_holiday", F.size("holidays") > 0).drop("_date", "_day")
