"""Moving points that share a coordinate apart for display."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.geo import lat_degrees, lon_degrees
from fleetwarden.functions.keys import stable_number
from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.ranking import number_rows


def _places(df: DataFrame, lat: str, lon: str, key: list[str], name: str) -> DataFrame:
    return number_rows(df, key, name, group=[lat, lon])


def _shift(df: DataFrame, lat: str, lon: str, moved: Column, radius: Column, angle: Column) -> DataFrame:
    dlat = lat_degrees(radius * F.sin(angle))
    dlon = lon_degrees(radius * F.cos(angle), F.col(lat))
    return df.withColumns(
        {
            lat: F.when(moved, F.col(lat) + dlat).otherwise(F.col(lat)),
            lon: F.when(moved, F.col(lon) + dlon).otherwise(F.col(lon)),
        }
    )


def spread_on_circle(
    df: DataFrame, key: list[str], lat: str = "lat", lon: str = "long", radius_m: float = 200.0
) -> DataFrame:
    """Points that share a coordinate go evenly around a circle; a lone point stays."""
    # NaN stands for a missing coordinate in the join key, as NaN equals NaN.
    spot = {"_lat": F.coalesce(F.col(lat), F.lit(float("nan"))), "_lon": F.coalesce(F.col(lon), F.lit(float("nan")))}
    sizes = df.withColumns(spot).groupBy("_lat", "_lon").agg(F.count(F.lit(1)).alias("_n"))
    placed = join_dimension(_places(df, lat, lon, key, "_k").withColumns(spot), sizes, ["_lat", "_lon"])
    angle = F.lit(2 * math.pi) * (F.col("_k") - 1) / F.col("_n")
    return _shift(placed, lat, lon, F.col("_n") > 1, F.lit(radius_m), angle).select(*df.columns)


def jitter_repeats(
    df: DataFrame, key: list[str], lat: str = "lat", lon: str = "long", reach_m: float = 30.0, seed: int = 0
) -> DataFrame:
    """Every point but the first of a coordinate moves by up to `reach_m`, drawn from its key."""
    draw = lambda tag: F.pmod(stable_number(F.lit(f"{seed}{tag}"), *key), F.lit(1_000_000)) / 1_000_000
    moved = F.col("_k") > 1
    placed = _places(df, lat, lon, key, "_k")
    return _shift(placed, lat, lon, moved, draw("r") * reach_m, draw("a") * (2 * math.pi)).select(*df.columns)


def gathered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with those of equal keys near each other, before an aggregate whose buffers are larger than rows.

    Where a group has few rows in any one task, reducing inside tasks shrinks nothing and shuffles a buffer for each
    row. The rows are dealt by a hash of the keys; adaptive execution splits a slice that a large group makes too large
    into several tasks, which then reduce it side by side, so an aggregate over the keys still merges across tasks.
    """
    return rows.withColumn("_near", F.xxhash64(*keys)).hint("rebalance", "_near").drop("_near")
