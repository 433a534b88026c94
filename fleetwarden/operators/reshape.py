"""Wide and long forms, unit expansion and time grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.keys import unit_key


def pivot_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values for a pivot, bounded by spark.sql.pivotMaxValues."""
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} values: use the long form")
    return sorted(r[0] for r in rows)


def pivot_prefixed(
    df: DataFrame, keys: list[str], column: str, value: Column, prefix: str, values: list | None = None
) -> DataFrame:
    """One column per value of `column`, named prefix + value."""
    values = pivot_values(df, column) if values is None else values
    wide = df.groupBy(*keys).pivot(column, values).agg(value)
    return wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def unpivot_prefixed(df: DataFrame, keys: list[str], prefix: str, column: str, value: str) -> DataFrame:
    """Back to long form; the prefix is removed from the names."""
    wide = [c for c in df.columns if c.startswith(prefix)]
    return df.unpivot(keys, wide, column, value).withColumn(column, F.expr(f"substring({column}, {len(prefix) + 1})"))


def expand_fleet(platforms: DataFrame, key: str, units: int, name: str = "turbine_id") -> DataFrame:
    """`units` unit rows per platform with value-based unit keys."""
    each = platforms.withColumn("unit_no", F.explode(F.sequence(F.lit(1), F.lit(units))))
    return each.withColumn(name, unit_key(key, "unit_no"))


def time_grid(df: DataFrame, start: str, end: str, step: int, name: str = "timestamp") -> DataFrame:
    """One row per step from start to end (unix seconds, end included)."""
    return df.withColumn(name, F.explode(F.sequence(F.col(start), F.col(end), F.lit(step).cast("bigint"))))
