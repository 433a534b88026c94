"""Row numbers, ranks, running totals and best-row picks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwarden.functions.temporal import stamp_in_name
from fleetwarden.session import staged


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. Spark limits each group inside every task before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_hour(df: DataFrame, unit: str = "turbine_id", hour: str = "hourly_timestamp") -> DataFrame:
    """One row per unit and hour, the least by its other columns: all hours stay. One partial aggregate, no sort."""
    others = [c for c in df.columns if c not in (unit, hour)]
    least = df.groupBy(unit, hour).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(unit, hour, "_least.*").select(*df.columns)


def latest_per_unit(df: DataFrame, unit: str = "turbine_id", hour: str = "hourly_timestamp") -> DataFrame:
    return keep_first(df, [unit], [F.col(hour).desc()])


def number_rows(
    df: DataFrame,
    order: list[str],
    name: str,
    group: list[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """row_number over (partition by group order by order), as a bigint.

    The rows are range partitioned and stored once, then numbered inside each slice and shifted by the counts of the
    slices before, so neither the whole table nor a hot group passes through one task. `order` must identify a
    row within its group.
    """
    group = list(group)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = staged(df.repartitionByRange(n, *group, *order).withColumn("_slice", F.spark_partition_id()))
    counts = cut.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    same = F.col("_slice") == F.col("_s")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = F.row_number().over(W.partitionBy(*group, "_slice").orderBy(*order))
    return (
        cut.withColumn("_rn", inside)
        .join(shift, same)
        .withColumn(name, (F.col("_rn") + F.col("_shift")).cast("bigint"))
        .select(*df.columns, name)
    )


def number_distinct(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct values of the columns, numbered 1..n in sorted order."""
    return number_rows(df.select(*columns).distinct(), columns, name)


def rank_ties_last(df: DataFrame, group: list[str], by: str, name: str, first: float = 0.1) -> DataFrame:
    """0-based rank within the group where tied rows all take the highest position; rank 0 becomes `first`."""
    peers = F.count(F.lit(1)).over(W.partitionBy(*group).orderBy(by)) - 1
    return df.withColumn(name, F.when(peers == 0, F.lit(first)).otherwise(peers.cast("double")))


def running_total(df: DataFrame, group: list[str], chunk: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Running sum per group in the order (chunk, order).

    Chunk totals are summed first and carried over, so a window never holds more than one (group, chunk) and a
    hot group is spread over its chunks. Null groups and chunks are groups and chunks (a null chunk is the first).
    """
    valued = df.withColumn("_v", value)
    totals = valued.groupBy(*group, chunk).agg(F.sum("_v").alias("_total"))
    before = W.partitionBy(*group).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    keys = [*group, chunk]
    carried = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    inside = W.partitionBy(*group, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        valued.withColumn("_inside", F.sum("_v").over(inside))
        .join(carried, same)
        .withColumn(name, F.col("_carried") + F.coalesce(F.col("_inside"), F.lit(0)))
        .select(*df.columns, name)
    )


def cumulative_class(percent: Column, shares) -> Column:
    """The class whose running share first exceeds `percent` (0..99); null when the shares end before it."""
    edge, chain = 0, None
    for label, share in shares:
        edge += share
        chain = F.when(percent < edge, label) if chain is None else chain.when(percent < edge, label)
    return chain


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows at the greatest timestamp, by an uncorrelated scalar subquery."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def best_row(df: DataFrame, metric: str, below: float = 1.0) -> DataFrame:
    """The row with the greatest metric under the ceiling."""
    return df.filter(F.col(metric) < below).orderBy(F.col(metric).desc(), *[c for c in df.columns if c != metric]).limit(1)


def newest_named(df: DataFrame, name: str, today: Column, max_age_days: int = 30) -> DataFrame:
    """The newest row by the stamp inside its name, if not older than the limit."""
    newest = (
        df.withColumn("stamp", stamp_in_name(name))
        .filter(F.col("stamp").isNotNull())
        .orderBy(F.col("stamp").desc(), F.col(name).desc())
        .limit(1)
    )
    return newest.withColumn("age_days", F.datediff(today, F.col("stamp"))).filter(F.col("age_days") <= max_age_days)
