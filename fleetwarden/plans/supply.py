"""Shipping cost, supply, demand, the optimisation table and shipment recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.geo import haversine_km
from fleetwarden.operators.joins import join_dimension, member_join, pair_grid
from fleetwarden.operators.ranking import rank_ties_last
from fleetwarden.operators.reshape import pivot_prefixed
from fleetwarden.operators.transport import shipments, totals
from fleetwarden.session import staged

ZERO_DISTANCE = 0.1


def site_port_distance(parts: DataFrame, platforms: DataFrame) -> DataFrame:
    """Kilometres between each stock site and each home port, 0 replaced by 0.1."""
    sites = parts.select("stock_location_id", F.col("lat").alias("_slat"), F.col("long").alias("_slon")).distinct()
    ports = platforms.select("home_location_id", F.col("lat").alias("_plat"), F.col("long").alias("_plon")).distinct()
    km = haversine_km(F.col("_slat"), F.col("_slon"), F.col("_plat"), F.col("_plon"))
    return (
        pair_grid(sites, ports)
        .withColumn("km", km)
        .select(
            "stock_location_id",
            "home_location_id",
            F.when(F.col("km") == 0, F.lit(ZERO_DISTANCE)).otherwise(F.col("km")).alias("km"),
        )
    )


def shipping_cost(parts: DataFrame, platforms: DataFrame, cost: str = "rank") -> DataFrame:
    """stock_location, homeport, distance: the port's rank by distance from the site, or the kilometres."""
    km = site_port_distance(parts, platforms)
    ranked = rank_ties_last(km, ["stock_location_id"], "km", "distance") if cost == "rank" else km.withColumn(
        "distance", F.col("km")
    )
    return ranked.select(
        F.col("stock_location_id").alias("stock_location"), F.col("home_location_id").alias("homeport"), "distance"
    )


def routes(cost: DataFrame, platforms: DataFrame) -> DataFrame:
    """Cost from each site to each designator."""
    ships = platforms.select("designator_id", "home_location_id").distinct()
    named = cost.select(
        F.col("stock_location").alias("stock_location_id"),
        F.col("homeport").alias("home_location_id"),
        F.col("distance").alias("cost"),
    )
    return join_dimension(ships, named, "home_location_id")


def supply(parts: DataFrame) -> DataFrame:
    return parts.groupBy("type", "stock_location_id").agg(F.max("inventory_level").alias("supply"))


def demand(gold: DataFrame, parts: DataFrame) -> DataFrame:
    """Units needing each part per designator: a unit counts once per part, whatever its hours and faults.

    Units are folded to their set of faults first and counted per (designator, set), so the parts are joined to
    a few summary rows rather than to the hours of every unit.
    """
    unit_faults = gold.groupBy("designator_id", "turbine_id").agg(
        F.sort_array(F.collect_set("prediction")).alias("faults")
    )
    summary = unit_faults.groupBy("designator_id", "faults").agg(F.count("turbine_id").alias("units"))
    needs = summary.withColumn("fault", F.explode("faults"))
    owners = parts.select(F.col("type").alias("parts"), "sensors").distinct()
    return (
        member_join(needs, owners, "fault", "sensors")
        .select("designator_id", "faults", "units", "parts")
        .distinct()
        .groupBy("designator_id", "parts")
        .agg(F.sum("units").alias("demand"))
    )


def lp_table(parts: DataFrame, platforms: DataFrame, gold: DataFrame, cost: str = "rank") -> DataFrame:
    """Long optimisation table: one row per demanded type, site and designator; missing demand is 0."""
    asked = staged(demand(gold, parts).withColumnRenamed("parts", "type"))
    stock = supply(parts).join(asked.select("type").distinct(), "type", "left_semi")
    lanes = routes(shipping_cost(parts, platforms, cost), platforms)
    return (
        join_dimension(lanes, stock, "stock_location_id")
        .join(asked, ["type", "designator_id"], "left")
        .select(
            "type",
            "stock_location_id",
            "designator_id",
            "home_location_id",
            "cost",
            F.coalesce("supply", F.lit(0)).alias("supply"),
            F.coalesce("demand", F.lit(0)).alias("demand"),
        )
    )


def cost_wide(lp: DataFrame, on: str = "designator_id", values: list | None = None) -> DataFrame:
    return pivot_prefixed(lp, ["type", "stock_location_id"], on, F.max("cost"), "Cost_", values)


def supply_wide(lp: DataFrame, values: list | None = None) -> DataFrame:
    return pivot_prefixed(lp, ["type"], "stock_location_id", F.max("supply"), "Supply_", values)


def demand_wide(lp: DataFrame, on: str = "designator_id", values: list | None = None) -> DataFrame:
    return pivot_prefixed(lp, ["type"], on, F.max("demand"), "Demand_", values)


def lp_wide(lp: DataFrame, sites: list | None = None, designators: list | None = None) -> DataFrame:
    """The wide form: Cost_*, Supply_* and Demand_* columns per (type, stock_location_id), nulls as 0.

    Given the values, no job looks for them, and the columns do not depend on the data.
    """
    lp = staged(lp)
    wide = cost_wide(lp, values=designators).join(supply_wide(lp, sites), "type")
    return wide.join(demand_wide(lp, values=designators), "type").fillna(0)


def with_names(plan: DataFrame, parts: DataFrame, platforms: DataFrame) -> DataFrame:
    """The plan with site and designator names; products without a plan have no rows here."""
    sites = parts.select("stock_location", "stock_location_id").distinct()
    names = platforms.select("designator", "designator_id").distinct()
    return join_dimension(join_dimension(plan, sites, "stock_location_id"), names, "designator_id")


class Shipping:
    """What the transport plan needs, each part stored once: asked, stock and cost; then plan and flows."""

    def __init__(self, parts: DataFrame, platforms: DataFrame, gold: DataFrame, cost: str = "rank"):
        ports = platforms.select("designator_id", F.col("home_location_id").alias("lane")).distinct()
        asked = demand(gold, parts).withColumnRenamed("parts", "type")
        self.asked = staged(join_dimension(asked, ports, "designator_id"))
        self.stock = staged(join_dimension(supply(parts), self.asked.select("type").distinct(), "type", "left_semi"))
        self.cost = staged(
            shipping_cost(parts, platforms, cost).select(
                F.col("stock_location").alias("stock_location_id"), F.col("homeport").alias("lane"), F.col("distance").alias("cost")
            )
        )
        plan, self.flows = shipments(self.asked, self.stock, self.cost)
        self.plan = staged(plan)


def infeasible_products(asked: DataFrame, stock: DataFrame, plan: DataFrame) -> DataFrame:
    """Products that the solver could not serve, for lack of stock or of a route, with their totals."""
    unserved = plan.filter(F.col("stock_location_id").isNull()).select("type").distinct()
    return totals(stock, asked).select("type", "total_supply", "total_demand").join(unserved, "type", "left_semi")
