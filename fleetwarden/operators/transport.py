"""Least-cost shipping of one product from stock sites to destinations, solved per product in parallel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.ranking import running_total
from fleetwarden.session import ship, staged

FLOW_SCHEMA = (
    "type string, stock_location_id string, lane string, flow bigint, cost double, supply bigint, demand bigint, "
    "site_price double, lane_price double"
)
CHUNKS = 64


def cheapest_flow(cost: np.ndarray, supply: np.ndarray, demand: np.ndarray) -> np.ndarray | None:
    """Whole-number shipments site x lane that meet the demand at least cost, or None if that cannot be done.

    Lanes are served one after another along the cheapest chain of re-routings: a site gives to the lane, and
    may free a unit by handing another lane to a site with stock to spare. Missing routes have infinite cost.
    """
    if np.any(cost < 0):
        raise ValueError("costs must not be negative")
    sites, lanes = cost.shape
    flow = np.zeros((sites, lanes), dtype=np.int64)
    spare = supply.astype(np.int64).copy()
    for lane in range(lanes):
        need = int(demand[lane])
        while need > 0:
            dist = cost[:, lane].astype(float).copy()
            came = np.full(sites, -1)
            moved = np.full(sites, -1)
            for _ in range(sites):
                changed = False
                for i in np.flatnonzero(flow.any(axis=1) & np.isfinite(dist)):
                    held = np.flatnonzero(flow[i] > 0)
                    swap = cost[:, held] - cost[i, held]
                    best = swap.argmin(axis=1)
                    reach = dist[i] + swap[np.arange(sites), best]
                    better = reach < dist - 1e-12
                    better[i] = False
                    if better.any():
                        dist[better], came[better], moved[better] = reach[better], i, held[best[better]]
                        changed = True
                if not changed:
                    break
            open_sites = np.where(spare > 0, dist, np.inf)
            last = int(open_sites.argmin())
            if not np.isfinite(open_sites[last]):
                return None
            chain, site = [], last
            while came[site] >= 0:
                chain.append((came[site], site, moved[site]))
                site = came[site]
            amount = min([need, int(spare[last])] + [int(flow[i, q]) for i, _, q in chain])
            for i, j, q in chain:
                flow[i, q] -= amount
                flow[j, q] += amount
            flow[site, lane] += amount
            spare[last] -= amount
            need -= amount
    return flow


def prices(cost: np.ndarray, supply: np.ndarray, flow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Site and lane prices that prove a plan least-cost: cost + site price >= lane price everywhere, equal where
    something flows, and a site with stock to spare costs nothing.

    All conditions bound differences of prices, so shortest distances that start from zero everywhere meet them; they
    settle because a least-cost plan leaves no cycle of re-routings that gains. Spare stock is the price of zero.
    """
    spare = supply > flow.sum(axis=1)
    shipped = np.where(flow > 0, cost, 0.0)
    site, lane, zero = np.zeros(cost.shape[0]), np.zeros(cost.shape[1]), 0.0
    for _ in range(sum(cost.shape) + 2):
        before = (*site, *lane, zero)
        lane = np.minimum(lane, (site[:, None] + cost).min(axis=0))
        site = np.minimum(site, np.where(flow > 0, lane - shipped, np.inf).min(axis=1))
        site = np.where(spare, np.minimum(site, zero), site)
        zero = min(zero, float(site.min()))
        if before == (*site, *lane, zero):
            break
    return site - zero, lane - zero


def solve_product(rows: pd.DataFrame) -> pd.DataFrame:
    """Flows of one product with their prices; a product that cannot be served gives one row of nulls."""
    product = rows["type"].iloc[0]
    cost = rows.pivot(index="stock_location_id", columns="lane", values="cost").sort_index().sort_index(axis=1)
    supply = rows.groupby("stock_location_id")["supply"].max().reindex(cost.index).to_numpy()
    demand = rows.groupby("lane")["demand"].max().reindex(cost.columns).to_numpy()
    costs = cost.fillna(np.inf).to_numpy()
    flow = cheapest_flow(costs, supply, demand)
    names = [part.split()[0] for part in FLOW_SCHEMA.split(", ")]
    if flow is None:
        return pd.DataFrame([[product, *[None] * (len(names) - 1)]], columns=names)
    site_price, lane_price = prices(costs, supply, flow)
    out = pd.DataFrame(flow, index=cost.index, columns=cost.columns).stack().rename("flow").reset_index()
    sites, lanes = flow.shape
    out["type"], out["cost"] = product, cost.to_numpy().ravel()
    out["supply"], out["demand"] = np.repeat(supply, lanes), np.tile(demand, sites)
    out["site_price"], out["lane_price"] = np.repeat(site_price, lanes), np.tile(lane_price, sites)
    return out[names]


def solve(problem: DataFrame, tasks: int | None = None) -> DataFrame:
    """Flows and prices of every product, from rows (type, stock_location_id, lane, cost, supply, demand); a task gets
    the sites x lanes rows of one product."""
    ship(problem.sparkSession)
    tasks = tasks or int(problem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(problem.repartition(tasks, "type").groupBy("type").applyInPandas(solve_product, FLOW_SCHEMA))


def optimality(flows: DataFrame) -> DataFrame:
    """Per solved product: its cost, and how many price conditions its plan breaks; none means that it is least-cost."""
    solved = flows.filter(F.col("lane").isNotNull())
    gap = F.col("cost") + F.col("site_price") - F.col("lane_price")
    used = F.sum("flow").over(W.partitionBy("type", "stock_location_id"))
    idle = (F.col("site_price") > 1e-9) & (used < F.col("supply"))
    return (
        solved.withColumns({"_gap": gap, "_idle": idle})
        .groupBy("type")
        .agg(
            F.sum(F.col("flow") * F.coalesce("cost", F.lit(0.0))).alias("total_cost"),
            F.count_if((F.col("_gap") < -1e-9) | (F.col("site_price") < -1e-9)).alias("reduced_cost_violations"),
            F.count_if(((F.col("flow") > 0) & (F.abs("_gap") > 1e-9)) | F.col("_idle")).alias("slack_violations"),
        )
    )


def deal_out(asked: DataFrame, flows: DataFrame) -> DataFrame:
    """Quantities (type, stock_location_id, designator_id, qty_shipped) for asked (type, designator_id, lane, demand), from
    flows (type, stock_location_id, lane, flow): both are laid along the same line, and overlaps are shipments."""
    along = W.partitionBy("type", "lane").orderBy("stock_location_id").rowsBetween(W.unboundedPreceding, 0)
    placed = flows.filter(F.col("flow") > 0).select(
        "type", "lane", "stock_location_id", "flow", F.sum("flow").over(along).alias("flow_end")
    )
    chunked = asked.withColumn("_chunk", F.pmod(F.xxhash64("designator_id"), F.lit(CHUNKS)))
    laid = running_total(chunked, ["type", "lane"], "_chunk", ["designator_id"], F.col("demand"), "asked_end")
    overlap = F.least("flow_end", "asked_end") - F.greatest(
        F.col("flow_end") - F.col("flow"), F.col("asked_end") - F.col("demand")
    )
    dealt = laid.join(placed, ["type", "lane"]).select(
        "type", "stock_location_id", "designator_id", overlap.cast("int").alias("qty_shipped")
    )
    return dealt.filter(F.col("qty_shipped") > 0)


def shipments(asked: DataFrame, stock: DataFrame, cost: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quantities shipped, flows with prices) without a table of all routes.

    asked has type, designator_id, lane, demand; stock has type, stock_location_id, supply; cost has
    stock_location_id, lane, cost. Demand is summed per lane, each product is solved over sites x lanes, and a lane's
    flow is dealt out to the designators that ask something, by laying flows and demands along the same line.
    Products that cannot be served give one row of nulls, also those without any stock.
    """
    asked = asked.filter(F.col("demand") > 0)
    wanted = asked.groupBy("type", "lane").agg(F.sum("demand").alias("demand"))
    problem = (
        wanted.join(stock.withColumn("supply", F.col("supply").cast("bigint")), "type")
        .join(cost, ["stock_location_id", "lane"], "left")
        .select("type", "stock_location_id", "lane", "cost", "supply", "demand")
    )
    flows = solve(problem)
    dealt = deal_out(asked, flows)
    unserved = flows.filter(F.col("lane").isNull()).select("type").unionByName(
        wanted.select("type").distinct().join(stock, "type", "left_anti")
    )
    nothing = unserved.select(
        "type",
        *[F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in ("stock_location_id", "designator_id", "qty_shipped")],
    )
    return dealt.unionByName(nothing), flows


def transport_plan(lp: DataFrame, lane: str, tasks: int | None = None) -> DataFrame:
    """Quantities per (type, stock_location_id, designator_id), zeros included; unservable products give one row of
    nulls. `shipments` makes the same plan without the table of all routes.

    `lp` is long: type, stock_location_id, designator_id, cost, supply, demand. Designators of one `lane`
    (same cost from every site, such as one home port) are interchangeable, so a product's task gets sites x
    lanes rows however many designators there are. The flow of a lane is then dealt out to its designators by
    laying site flows and designator demands along the same line and taking the overlaps. Where each designator
    has costs of its own, "designator_id" is the lane of a small problem, and transport_prices.least_cost solves a
    large one without a product's table in one task.
    """
    lp = lp.withColumn("lane", F.col(lane).cast("string"))
    problem = lp.groupBy("type", "stock_location_id", "lane").agg(
        F.max("cost").alias("cost"), F.max("supply").cast("bigint").alias("supply"), F.sum("demand").alias("demand")
    )
    flows = solve(problem, tasks)
    if lane == "designator_id":
        return flows.select(
            "type",
            "stock_location_id",
            F.col("lane").cast(lp.schema["designator_id"].dataType).alias("designator_id"),
            F.col("flow").cast("int").alias("qty_shipped"),
        )
    return _deal_out(lp, flows)


def _deal_out(lp: DataFrame, flows: DataFrame) -> DataFrame:
    along = W.partitionBy("type", "lane").orderBy("stock_location_id").rowsBetween(W.unboundedPreceding, 0)
    placed = flows.filter(F.col("flow") > 0).select(
        "type", "stock_location_id", "lane", "flow", F.sum("flow").over(along).alias("flow_end")
    )
    asked = lp.withColumn("_chunk", F.pmod(F.xxhash64("designator_id"), F.lit(CHUNKS)))
    asked = running_total(
        asked, ["type", "stock_location_id", "lane"], "_chunk", ["designator_id"], F.col("demand"), "asked_end"
    )
    overlap = F.least("flow_end", "asked_end") - F.greatest(
        F.col("flow_end") - F.col("flow"), F.col("asked_end") - F.col("demand")
    )
    unservable = flows.filter(F.col("lane").isNull()).select("type")
    servable = join_dimension(asked, unservable, "type", "left_anti")
    dealt = (
        join_dimension(servable, placed, ["type", "stock_location_id", "lane"], "left")
        .select(
            "type",
            "stock_location_id",
            "designator_id",
            F.when(F.col("flow") > 0, F.greatest(overlap, F.lit(0))).otherwise(0).cast("int").alias("qty_shipped"),
        )
    )
    nothing = unservable.select(
        "type",
        F.lit(None).cast("string").alias("stock_location_id"),
        F.lit(None).cast(lp.schema["designator_id"].dataType).alias("designator_id"),
        F.lit(None).cast("int").alias("qty_shipped"),
    )
    return dealt.unionByName(nothing)


def feasibility(lp: DataFrame) -> DataFrame:
    """Per product: total supply, total demand and whether the supply suffices (every site reaches everyone)."""
    stock = lp.groupBy("type", "stock_location_id").agg(F.max("supply").alias("supply"))
    asked = lp.groupBy("type", "designator_id").agg(F.max("demand").alias("demand"))
    return totals(stock, asked)


def totals(stock: DataFrame, asked: DataFrame) -> DataFrame:
    """Per asked product: total supply, total demand and whether the supply suffices."""
    return (
        asked.groupBy("type")
        .agg(F.sum("demand").alias("total_demand"))
        .join(stock.groupBy("type").agg(F.sum("supply").alias("total_supply")), "type", "left")
        .fillna(0, ["total_supply"])
        .withColumn("feasible", F.col("total_supply") >= F.col("total_demand"))
    )


def plan_audit(asked: DataFrame, stock: DataFrame, plan: DataFrame) -> DataFrame:
    """Per solved product: shipped units, sites over their supply, designators short of their demand."""
    solved = plan.filter(F.col("stock_location_id").isNotNull())
    left = solved.groupBy("type", "stock_location_id").agg(F.sum("qty_shipped").alias("shipped"))
    sites = left.join(stock, ["type", "stock_location_id"], "left").groupBy("type").agg(
        F.sum("shipped").alias("shipped"),
        F.count_if(F.col("shipped") > F.coalesce("supply", F.lit(0))).alias("sites_overdrawn"),
    )
    got = solved.groupBy("type", "designator_id").agg(F.sum("qty_shipped").alias("got"))
    short = asked.join(got, ["type", "designator_id"], "left").groupBy("type").agg(
        F.count_if(F.coalesce("got", F.lit(0)) < F.col("demand")).alias("designators_short")
    )
    return sites.join(short, "type")
