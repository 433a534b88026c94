import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwarden.operators import transport_prices
from fleetwarden.operators.transport import cheapest_flow
from fleetwarden.session import staged


def problem(spark, seed, types=3, sites=3, places=60, whole=False, gaps=0.0):
    rng = np.random.default_rng(seed)
    cost = rng.integers(1, 6, (sites, places)).astype(float) if whole else rng.random((sites, places)) * 1000
    cost[rng.random(cost.shape) < gaps] = np.inf
    demand = rng.integers(0, 9, (types, places))
    total = demand.sum(axis=1)
    supply = np.stack([rng.multinomial(int(t * 1.1) + 1, rng.dirichlet(np.ones(sites))) for t in total])
    asked = [(f"t{t}", j, int(demand[t, j])) for t in range(types) for j in range(places)]
    stock = [(f"t{t}", f"s{i}", int(supply[t, i])) for t in range(types) for i in range(sites)]
    routes = [(f"s{i}", j, float(cost[i, j])) for i in range(sites) for j in range(places) if np.isfinite(cost[i, j])]
    frames = (
        spark.createDataFrame(asked, "type string, designator_id int, demand bigint"),
        spark.createDataFrame(stock, "type string, stock_location_id string, supply int"),
        spark.createDataFrame(routes, "stock_location_id string, designator_id int, cost double"),
    )
    return frames, cost, supply, demand


@pytest.mark.parametrize("seed,whole,gaps,sums", [(1, False, 0.0, 500), (2, False, 0.0, 5), (3, True, 0.0, 5), (4, False, 0.3, 8)])
def test_cost_equals_that_of_one_exact_solver(spark, monkeypatch, seed, whole, gaps, sums):
    monkeypatch.setattr(transport_prices, "SUMS", sums)
    frames, cost, supply, demand = problem(spark, seed, whole=whole, gaps=gaps)
    plan, priced = transport_prices.least_cost(*frames)
    plan = staged(plan)
    got = {r["type"]: r for r in transport_prices.proof(plan, priced).collect()}
    unserved = {r["type"] for r in plan.filter("stock_location_id IS NULL").collect()}
    for t in range(len(supply)):
        flow = cheapest_flow(cost, supply[t], demand[t])
        if flow is None:
            assert f"t{t}" in unserved and f"t{t}" not in got
            continue
        row = got[f"t{t}"]
        assert row["shipped"] == demand[t].sum()
        assert row["total_cost"] == pytest.approx(float(np.where(flow > 0, cost * flow, 0).sum()))
        assert (row["dear_routes"], row["site_violations"], row["not_as_asked"]) == (0, 0, 0)


def test_products_without_stock_or_enough_of_it(spark):
    asked = spark.createDataFrame([("a", 1, 5), ("b", 1, 5), ("c", 1, 5), ("c", 2, 0)], "type string, designator_id int, demand bigint")
    stock = spark.createDataFrame([("a", "s", 4), ("b", "s", 5)], "type string, stock_location_id string, supply int")
    cost = spark.createDataFrame([("s", 1, 2.0)], "stock_location_id string, designator_id int, cost double")
    plan, priced = transport_prices.least_cost(asked, stock, cost)
    assert sorted(map(tuple, plan.collect()), key=str) == [("a", None, None, None), ("b", "s", 1, 5), ("c", None, None, None)]
    assert transport_prices.proof(plan, priced).first()["total_cost"] == 10.0
    nothing, _ = transport_prices.least_cost(asked.limit(0), stock, cost)
    assert nothing.count() == 0


def test_a_worse_plan_does_not_pass(spark):
    frames, *_ = problem(spark, 6, types=1)
    plan, priced = transport_prices.least_cost(*frames)
    swapped = plan.withColumn("stock_location_id", F.when(F.col("stock_location_id") == "s0", "s1").otherwise("s0"))
    broken = transport_prices.proof(swapped, priced).first()
    assert broken["dear_routes"] > 0
    assert transport_prices.proof(plan.limit(3), priced).first()["not_as_asked"] > 0


def test_products_are_solved_in_tasks_of_their_own(spark, monkeypatch):
    files = []

    def kept(df):
        out = staged(df)
        if out.columns == ["type", "costs", "flows", "site_prices"]:
            files.append(len([f for f in out.inputFiles() if spark.read.parquet(f).select("type").limit(1).count()]))
        return out

    monkeypatch.setattr(transport_prices, "staged", kept)
    frames, *_ = problem(spark, 7, types=12, places=20)
    transport_prices.least_cost(*frames)
    assert files and min(files) >= 8  # twelve products in 32 tasks
