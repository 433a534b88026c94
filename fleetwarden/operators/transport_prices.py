"""Least-cost shipping where every destination has costs of its own, such as platforms at sea.

Only the sites' prices couple the destinations, and there are few sites. A destination whose cheapest site (cost plus
price) is clearly ahead of the others is decided, and decided ones are one sum for each site. So a round prices all
destinations with one aggregate, solves each product over its sites and the sums, and opens the destinations that the new
prices leave undecided: first on rounded costs, at the end on exact ones. It is done when no decided destination has a
cheaper site at the prices found; prices and plan then prove each other least-cost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.transport import cheapest_flow, deal_out, prices
from fleetwarden.session import ship, staged

#: Undecided sums of one product that a round solves at most on rounded costs, steps of a cost's range at first, and
#: times finer that each round is.
SUMS, STEPS, FINER = 500, 4, 4
ROUNDS = 40
#: Tasks for each core over which the products of a round are dealt.
TASKS_A_CORE = 4
CLOSE = 1e-9

SOLVED = "type string, costs array<double>, flows array<bigint>, site_prices array<double>"


def _solve(key: tuple, sums: pd.DataFrame, stock: pd.DataFrame) -> pd.DataFrame:
    """Flows of each sum to the sites of one product, and the sites' prices; null flows where it cannot be served."""
    if not len(sums) or not len(stock):
        return pd.DataFrame({c.split()[0]: [] for c in SOLVED.split(", ")}, dtype=object)
    supply = np.array(stock["supplies"].iloc[0], np.int64)
    cost = np.stack(sums["costs"].to_list()).astype(float).T
    flow = cheapest_flow(cost, supply, sums["demand"].to_numpy().astype(np.int64))
    if flow is None:
        return pd.DataFrame({"type": [key[0]], "costs": [None], "flows": [None], "site_prices": [None]}, dtype=object)
    site, _ = prices(cost, supply, flow)
    return pd.DataFrame(
        {"type": key[0], "costs": sums["costs"], "flows": list(flow.T.copy()), "site_prices": [site] * len(sums)}
    )


def _with_slack(priced: DataFrame) -> DataFrame:
    """priced plus `slack`: how much dearer each site is than the cheapest, prices included.

    Sums and their least are columns of their own, so they are made once a row and not once for each site.
    """
    whole = priced.withColumn("_whole", F.zip_with("costs", "site_prices", lambda c, p: c + p))
    least = whole.withColumn("_least", F.array_min("_whole"))
    return least.withColumn("slack", F.transform("_whole", lambda v: v - F.col("_least"))).drop("_whole", "_least")


def _only(costs: Column, site: Column) -> Column:
    """Costs of a decided destination's sum: its site is free, the others are out of reach."""
    return F.transform(costs, lambda c, i: F.when(i == site, 0.0).otherwise(float("inf")))


def least_cost(asked: DataFrame, stock: DataFrame, cost: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quantities shipped, priced destinations) for costs that differ by destination.

    asked has type, designator_id, demand; stock has type, stock_location_id, supply; cost has stock_location_id,
    designator_id, cost, and a missing route has none. Rows of the plan are type, stock_location_id, designator_id,
    qty_shipped; a product that cannot be served gives one row of nulls. The second table has a row (type,
    designator_id, demand, sites, supplies, costs, site_prices) for each destination of a solved product; see `proof`.

    A destination with its sites is one row and a product is no group: a task gets a product's sums, of which undecided
    ones are few, and sites, which are assumed to be at most some hundreds. The exact round has one sum for each
    undecided destination, or for all that share the same costs.
    """
    spark = asked.sparkSession
    ship(spark)
    asked = asked.filter(F.col("demand") > 0).groupBy("type", "designator_id").agg(F.sum("demand").alias("demand"))
    sites = stock.groupBy("type").agg(
        F.array_sort(F.collect_list(F.struct("stock_location_id", F.col("supply").cast("bigint").alias("supply")))).alias("s")
    )
    sites = staged(sites.select("type", F.col("s.stock_location_id").alias("sites"), F.col("s.supply").alias("supplies")))
    routes = cost.groupBy("designator_id").agg(F.map_from_entries(F.collect_list(F.struct("stock_location_id", F.col("cost").cast("double")))).alias("m"))
    far = F.lit(float("inf"))
    reach = F.transform("sites", lambda s: F.coalesce(F.element_at("m", s), far))
    base = staged(
        asked.join(sites, "type")
        .join(routes, "designator_id", "left")
        .select("type", "designator_id", "demand", F.coalesce(reach, F.transform("sites", lambda s: far)).alias("costs"))
    )
    finite = F.filter("costs", lambda c: c < far)
    widest = base.select(F.max(F.array_max(finite) - F.array_min(finite))).first()[0] or 0.0
    quantum, margin = widest / STEPS, float("inf")
    priced = base.withColumn("site_prices", F.transform("costs", lambda c: F.lit(0.0))).withColumn("opened", F.lit(False))
    exact, tasks = False, TASKS_A_CORE * spark.sparkContext.defaultParallelism
    for _ in range(ROUNDS):
        slacked = _with_slack(priced)
        near = F.size(F.filter("slack", lambda v: v <= margin)) > 1
        marked = slacked.withColumn("site", F.array_position("slack", F.lit(0.0)).cast("int") - 1).withColumn("open", F.col("opened") | near)
        round_ = staged(marked.select("type", "designator_id", "demand", "costs", "open", "site"))
        undecided = round_.filter("open").groupBy("type", "costs").agg(F.count(F.lit(1)).alias("n")).groupBy("type").count()
        exact = exact or quantum <= CLOSE or (undecided.agg(F.max("count")).first()[0] or 0) <= SUMS
        rounded = F.col("costs") if exact else F.transform("costs", lambda c: F.when(c < far, F.round(c / quantum) * quantum).otherwise(c))
        key = F.when(F.col("open"), rounded).otherwise(_only(F.col("costs"), F.col("site")))
        keyed = round_.withColumn("key", key)
        sums = keyed.groupBy("type", F.col("key").alias("costs")).agg(F.sum("demand").alias("demand"))
        # Few bytes and much work: with a fixed number of tasks, adaptive execution does not put all products into one.
        dealt_out = [t.repartition(tasks, "type").groupBy("type") for t in (sums, sites)]
        solved = staged(dealt_out[0].cogroup(dealt_out[1]).applyInPandas(_solve, SOLVED))
        found = solved.filter("flows IS NOT NULL").groupBy("type").agg(F.first("site_prices").alias("site_prices"))
        priced = round_.join(found, "type").withColumn("opened", F.lit(False))
        if exact:
            # A decided destination that has a cheaper site at these prices is opened and stays so.
            wrong = ~F.col("open") & (F.element_at("slack", F.col("site") + 1) > CLOSE)
            checked = _with_slack(priced).withColumn("wrong", wrong).drop("slack")
            left = checked.agg(F.count_if("wrong")).first()[0]
            if not left:
                break
            priced, margin = checked.withColumn("opened", F.col("open") | F.col("wrong")).drop("wrong"), -1.0
        else:
            margin, quantum = 2 * STEPS * quantum, quantum / FINER
    else:
        raise RuntimeError(f"prices did not settle in {ROUNDS} rounds")
    lane = F.xxhash64("costs").cast("string")
    flows = solved.filter("flows IS NOT NULL").join(sites, "type").select(
        "type", lane.alias("lane"), F.explode(F.arrays_zip("sites", "flows")).alias("f")
    ).select("type", "lane", F.col("f.sites").alias("stock_location_id"), F.col("f.flows").alias("flow"))
    wanted = keyed.join(found, "type").select("type", "designator_id", "demand", F.xxhash64("key").cast("string").alias("lane"))
    dealt = deal_out(wanted, flows)
    unserved = asked.select("type").distinct().join(found, "type", "left_anti")
    nothing = unserved.select("type", *[F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in dealt.columns[1:]])
    certificate = round_.join(found, "type").join(sites, "type").select("type", "designator_id", "demand", "sites", "supplies", "costs", "site_prices")
    return dealt.unionByName(nothing), staged(certificate)


def proof(plan: DataFrame, priced: DataFrame) -> DataFrame:
    """Per solved product: units and cost, and how many conditions the plan breaks; none means that it is least-cost.

    Every unit has to come from a site that is cheapest for its destination at the prices, prices are not negative, a
    site with stock to spare has none, no site gives more than it has, and every destination gets what it asked.
    """
    each = _with_slack(priced).select("type", "designator_id", F.explode(F.arrays_zip("sites", "costs", "slack")).alias("r"))
    each = each.select("type", "designator_id", F.col("r.sites").alias("stock_location_id"), F.col("r.costs").alias("cost"), F.col("r.slack").alias("slack"))
    shipped = plan.filter(F.col("stock_location_id").isNotNull())
    moved = shipped.join(each, ["type", "designator_id", "stock_location_id"], "left").groupBy("type").agg(
        F.sum("qty_shipped").alias("shipped"),
        F.sum(F.col("qty_shipped") * F.col("cost")).alias("total_cost"),
        F.count_if(F.coalesce(F.col("slack") > 1e-6, F.lit(True))).alias("dear_routes"),
    )
    one = priced.groupBy("type").agg(F.first(F.arrays_zip("sites", "supplies", "site_prices")).alias("z")).select("type", F.explode("z").alias("r"))
    used = shipped.groupBy("type", "stock_location_id").agg(F.sum("qty_shipped").alias("used"))
    gave = F.coalesce("used", F.lit(0))
    sites = (
        one.select("type", F.col("r.sites").alias("stock_location_id"), F.col("r.supplies").alias("supply"), F.col("r.site_prices").alias("price"))
        .join(used, ["type", "stock_location_id"], "left")
        .groupBy("type")
        .agg(F.count_if((F.col("price") < -CLOSE) | ((F.col("price") > 1e-6) & (gave < F.col("supply"))) | (gave > F.col("supply"))).alias("site_violations"))
    )
    got = shipped.groupBy("type", "designator_id").agg(F.sum("qty_shipped").alias("got"))
    short = priced.join(got, ["type", "designator_id"], "left").groupBy("type").agg(
        F.count_if(F.coalesce("got", F.lit(0)) != F.col("demand")).alias("not_as_asked")
    )
    return moved.join(sites, "type").join(short, "type")
