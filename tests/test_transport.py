import itertools
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetwarden.operators import transport


def brute_force(cost, supply, demand):
    """Least cost over all whole-number plans that meet the demand exactly; None without one."""
    sites, lanes = cost.shape
    splits = [
        [s for s in itertools.product(range(d + 1), repeat=sites) if sum(s) == d] for d in demand
    ]
    best = None
    for choice in itertools.product(*splits):
        plan = np.array(choice).T
        if (plan.sum(axis=1) <= supply).all():
            total = float((plan * cost).sum())
            best = total if best is None else min(best, total)
    return best


def test_small_problems_against_brute_force():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        sites, lanes = rnd.integers(1, 4, 2)
        cost = rnd.integers(0, 6, (sites, lanes)).astype(float)
        supply, demand = rnd.integers(0, 5, sites), rnd.integers(0, 4, lanes)
        flow, best = transport.cheapest_flow(cost, supply, demand), brute_force(cost, supply, demand)
        if best is None:
            assert flow is None and supply.sum() < demand.sum()
        else:
            assert (flow >= 0).all() and (flow.sum(axis=0) == demand).all() and (flow.sum(axis=1) <= supply).all()
            assert float((flow * cost).sum()) == best


def test_missing_route_and_negative_cost():
    cost = np.array([[np.inf, 1.0]])
    assert transport.cheapest_flow(cost, np.array([5]), np.array([1, 1])) is None
    assert transport.cheapest_flow(cost, np.array([5]), np.array([0, 1])).tolist() == [[0, 1]]
    with pytest.raises(ValueError):
        transport.cheapest_flow(np.array([[-1.0]]), np.array([1]), np.array([1]))


def random_lp(spark, seed, ports=3, per_port=4, sites=3, types=6):
    rnd = random.Random(seed)
    data = []
    for t in range(types):
        supply = [rnd.randrange(0, 16) for _ in range(sites)]
        cost = [[rnd.randrange(1, 9) for _ in range(ports)] for _ in range(sites)]
        for d in range(ports * per_port):
            need = rnd.randrange(0, 4)
            for s in range(sites):
                data.append((f"t{t}", f"s{s}", d, f"h{d % ports}", float(cost[s][d % ports]), supply[s], need))
    return spark.createDataFrame(
        data, "type string, stock_location_id string, designator_id bigint, home_location_id string, cost double, "
        "supply int, demand bigint"
    )


def test_lanes_give_the_same_cost_as_single_designators(spark):
    lp = random_lp(spark, 11).cache()
    total = lambda plan: rows(
        lp.join(plan, ["type", "stock_location_id", "designator_id"])
        .groupBy("type")
        .agg(F.sum(F.col("cost") * F.col("qty_shipped")))
    )
    by_lane, single = transport.transport_plan(lp, "home_location_id"), transport.transport_plan(lp, "designator_id")
    assert total(by_lane) == total(single)
    solved = {r["type"] for r in transport.feasibility(lp).filter("feasible").collect()}
    assert 0 < len(solved) < 6
    stock = lp.groupBy("type", "stock_location_id").agg(F.max("supply").alias("supply"))
    asked = lp.select("type", "designator_id", F.col("home_location_id").alias("lane"), "demand").distinct()
    audit = transport.plan_audit(asked, stock, by_lane).collect()
    assert {r["type"] for r in audit} == solved
    assert all(r["sites_overdrawn"] == 0 and r["designators_short"] == 0 for r in audit)
    nothing = [tuple(r) for r in by_lane.filter("designator_id IS NULL").collect()]
    assert {n[0] for n in nothing} == {f"t{i}" for i in range(6)} - solved and all(n[1:] == (None,) * 3 for n in nothing)


def test_prices_prove_random_plans():
    rnd = np.random.default_rng(8)
    solved = 0
    for _ in range(400):
        sites, lanes = rnd.integers(1, 5, 2)
        cost = rnd.integers(0, 7, (sites, lanes)).astype(float)
        cost[rnd.random((sites, lanes)) < 0.15] = np.inf
        supply, demand = rnd.integers(0, 6, sites), rnd.integers(1, 5, lanes)
        flow = transport.cheapest_flow(cost, supply, demand)
        if flow is None:
            continue
        solved += 1
        site, lane = transport.prices(cost, supply, flow)
        gap = cost + site[:, None] - lane
        assert (gap[np.isfinite(cost)] >= -1e-9).all() and (site >= -1e-9).all()
        assert np.abs(gap[flow > 0]).max(initial=0) < 1e-9
        assert (site[flow.sum(axis=1) < supply] == 0).all()
    assert solved > 100


def test_shipments_without_the_table_of_all_routes(spark):
    lp = random_lp(spark, 11)
    asked = lp.select("type", "designator_id", F.col("home_location_id").alias("lane"), "demand").distinct()
    asked = asked.unionByName(spark.createDataFrame([("none", 1, "h1", 2)], "type string, designator_id bigint, lane string, demand bigint"))
    stock = lp.groupBy("type", "stock_location_id").agg(F.max("supply").alias("supply"))
    cost = lp.groupBy("stock_location_id", F.col("home_location_id").alias("lane"), "type").agg(F.max("cost").alias("cost"))
    for kind in [r[0] for r in lp.select("type").distinct().collect()] + ["none"]:
        own = F.col("type") == kind
        plan, flows = transport.shipments(asked.filter(own), stock.filter(own), cost.filter(own).drop("type"))
        whole = rows(transport.transport_plan(lp.filter(own), "home_location_id").filter("qty_shipped > 0 OR qty_shipped IS NULL"))
        if kind == "none":
            assert rows(plan) == [("none", None, None, None)]
            continue
        price = {(r["stock_location_id"], r["lane"]): r["cost"] for r in cost.filter(own).collect()}
        total = lambda found: sum(q * price[s, f"h{d % 3}"] for _, s, d, q in found if q)
        assert total(rows(plan)) == total(whole)
        assert all(r["reduced_cost_violations"] == r["slack_violations"] == 0 for r in transport.optimality(flows).collect())


def test_zero_quantity_routes_stay(spark):
    lp = random_lp(spark, 11)
    solved = transport.feasibility(lp).filter("feasible").select("type")
    assert transport.transport_plan(lp, "home_location_id").dropna().count() == lp.join(solved, "type").count()
