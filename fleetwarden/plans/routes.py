"""Arcs from stock sites to platforms for a map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.spread import spread_on_circle

TARGET_RADIUS_M = 400.0


def simulated_position(platforms: DataFrame) -> DataFrame:
    """Platforms at sea take their simulated position; text coordinates become numbers."""
    if "sim_lat" in platforms.columns:
        platforms = platforms.drop("lat", "long").withColumnsRenamed({"sim_lat": "lat", "sim_lon": "long"})
    return platforms.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "long")})


def route_arcs(shipments: DataFrame, parts: DataFrame, platforms: DataFrame) -> DataFrame:
    """Positive shipments with rounded source and circle-spread target coordinates; unknown ends stay null."""
    sites = parts.select(
        "stock_location_id",
        F.round("lat", 0).alias("source_lat"),
        F.round("long", 0).alias("source_lng"),
        F.col("stock_location").alias("stock_name"),
    ).distinct()
    spread = spread_on_circle(simulated_position(platforms), ["designator"], radius_m=TARGET_RADIUS_M)
    targets = spread.select("designator", F.col("lat").alias("target_lat"), F.col("long").alias("target_lng"))
    positive = shipments.filter(F.col("qty_shipped") > 0).drop("stock_location")
    located = join_dimension(join_dimension(positive, sites, "stock_location_id", "left"), targets, "designator", "left")
    # Names and order of the arc table.
    return located.select(
        "stock_location_id",
        "designator",
        "type",
        "qty_shipped",
        "source_lat",
        "source_lng",
        "target_lat",
        "target_lng",
        "stock_name",
    )
