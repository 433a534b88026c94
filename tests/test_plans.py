import math
import re

from conftest import rows
from pyspark.sql import functions as F

from fleetwarden.functions.arrays import clean_request
from fleetwarden.operators import spread, transport
from fleetwarden.plans import gold, routes, supply, tickets
from fleetwarden.plans import bindings as b
from fleetwarden.schemas import maintenance_actions
from fleetwarden.session import staged


def parts(spark):
    data = [("p", ["sensor_A", "sensor_B"], "s1", 10.0, 10.0, 5), ("q", ["sensor_B"], "s1", 10.0, 10.0, 1)]
    return spark.createDataFrame(
        data, "type string, sensors array<string>, stock_location_id string, lat double, long double, inventory_level int"
    ).withColumns({"stock_location": F.lit("Site"), "NSN": F.concat(F.lit("N-"), "type")})


def status(spark):
    data = [("d", 1, "u", 1, "sensor_A"), ("d", 1, "u", 2, "sensor_B"), ("d", 1, "v", 1, "sensor_B"),
            ("e", 2, "w", 1, "ok"), ("e", 2, "x", 1, None)]
    return spark.createDataFrame(
        data, "designator string, designator_id int, turbine_id string, hourly_timestamp int, prediction string"
    )


def test_demand_counts_a_unit_once_per_part(spark):
    got = rows(supply.demand(status(spark), parts(spark)))
    assert got == [(1, "p", 2), (1, "q", 2)]
    literal = status(spark).join(parts(spark), F.array_contains("sensors", F.col("prediction")))
    want = literal.select("designator_id", "turbine_id", "type").distinct().groupBy("designator_id", "type").count()
    assert got == rows(want)


def test_lp_keeps_designators_without_demand(spark):
    platforms = spark.createDataFrame(
        [("d", 1, "h1", 10.0, 10.0), ("e", 2, "h2", 20.0, 20.0)],
        "designator string, designator_id int, home_location_id string, lat double, long double",
    )
    got = rows(supply.lp_table(parts(spark), platforms, status(spark)).select("type", "designator_id", "cost", "supply", "demand"))
    assert got == [("p", 1, 0.1, 5, 2), ("p", 2, 1.0, 5, 0), ("q", 1, 0.1, 1, 2), ("q", 2, 1.0, 1, 0)]
    km = supply.site_port_distance(parts(spark), platforms).collect()
    assert min(r["km"] for r in km) == 0.1


def test_required_parts_once_or_per_hour(spark):
    two_hours = status(spark).union(status(spark).filter("turbine_id = 'v'"))
    got = rows(tickets.required_parts(two_hours, parts(spark)))
    assert got == [("u", "sensor_A", ["p"]), ("u", "sensor_B", ["p", "q"]), ("v", "sensor_B", ["p", "q"])]
    again = rows(tickets.required_parts(two_hours, parts(spark), keep_duplicates=True))
    assert again[2] == ("v", "sensor_B", ["p", "p", "q", "q"])
    # Two stock numbers of one type count each of their hours; the plain list names the type once.
    second = parts(spark).unionByName(parts(spark).filter("type = 'q'").withColumn("NSN", F.lit("N-other")))
    assert rows(tickets.required_parts(two_hours, second, keep_duplicates=True))[2][2] == ["p", "p", "q", "q", "q", "q"]
    assert rows(tickets.required_parts(two_hours, second))[2][2] == ["p", "q"]
    long = rows(tickets.required_parts_long(two_hours, parts(spark)).filter("turbine_id = 'v'"))
    assert long == [("v", "sensor_B", "N-p", "p", 2), ("v", "sensor_B", "N-q", "q", 2)]


def test_work_orders_need_a_part_order_and_more_than_999_fit(spark):
    many = spark.range(1200).select(
        F.lit("d").alias("designator"), F.lit(1).alias("designator_id"),
        F.format_string("u%05d", "id").alias("turbine_id"), F.lit(1).alias("hourly_timestamp"),
        F.lit("sensor_B").alias("prediction"), F.lit("Depot Level").alias("maintenance_type"),
    )
    none = many.limit(1).withColumn("designator", F.lit("z")).withColumn("turbine_id", F.lit("zz"))
    shipped = spark.createDataFrame(
        [("s1", 1, "p", 2, "d"), ("s1", 1, "q", 1, "d"), ("s2", 1, "p", 0, "d"), ("s2", 1, "q", 3, "d")],
        "stock_location_id string, designator_id int, type string, qty_shipped int, designator string",
    )
    orders = tickets.part_orders(shipped)
    assert sorted(r["order_number"] for r in orders.collect()) == ["PR-000001", "PR-000001", "PR-000002"]
    work = tickets.work_orders(many.union(none), parts(spark), orders).collect()
    assert len(work) == 1200 and {r["priority"] for r in work} == {"CASREP"}
    assert max(r["work_order"] for r in work if r["turbine_id"] == "u01199") == "AI-WO 1200"
    assert work[0]["part_orders"] == ["PR-000001", "PR-000002"]


def test_gold_keeps_healthy_rows_and_drops_missing_predictions(spark):
    silver = spark.createDataFrame([("u", 1), ("v", 1), ("n", 1)], "turbine_id string, hourly_timestamp int")
    meta = spark.createDataFrame([("u", "d"), ("v", "d"), ("n", "d")], "turbine_id string, designator string")
    meta = meta.union(meta)  # a repeated platform row must not repeat a unit's hours
    scorer = F.when(F.col("turbine_id") == "u", "sensor_F").when(F.col("turbine_id") == "v", "ok")
    got = gold.status_gold(silver, meta, maintenance_actions(spark), scorer)
    assert rows(got.select("turbine_id", "prediction", "maintenance_type", "operable")) == [
        ("u", "sensor_F", "Depot Level", False),
        ("v", "ok", None, None),
    ]


def test_circle(spark):
    points = [(f"a{i}", 10.0, 20.0) for i in range(5)] + [("b", 1.0, 2.0), ("c", None, None), ("d", None, None),
                                                          ("e", 89.9, 0.0), ("f", 89.9, 0.0)]
    df = spark.createDataFrame(points, "k string, lat double, long double")
    got = {r["k"]: r for r in spread.spread_on_circle(df, ["k"], radius_m=200).collect()}
    assert len(got) == 10 and got["b"]["lat"] == 1.0 and got["c"]["lat"] is None
    for i in range(5):
        a = 2 * math.pi * i / 5
        assert math.isclose(got[f"a{i}"]["lat"], 10 + 200 * math.sin(a) / 111000)
        assert math.isclose(got[f"a{i}"]["long"], 20 + 200 * math.cos(a) / (111000 * math.cos(math.radians(10))))
    assert abs(got["e"]["long"]) > 1


def test_jitter_leaves_the_first_point(spark):
    df = spark.createDataFrame([("a", 10.0, 20.0), ("b", 10.0, 20.0), ("c", 10.0, 20.0)], "k string, lat double, long double")
    got = {r["k"]: (r["lat"], r["long"]) for r in spread.jitter_repeats(df, ["k"]).collect()}
    assert got["a"] == (10.0, 20.0) and got["b"] != got["c"] != (10.0, 20.0)
    assert all(abs(lat - 10) <= 30 / 111000 for lat, _ in got.values())


def test_request_coercion(spark):
    df = spark.createDataFrame(
        [(None, "[1, 2]", [1.0]), ("x", "[1, b]", None), ("2.5", None, [3.0])], "n string, t string, a array<double>"
    )
    got = [tuple(r) for r in clean_request(df, ["n"], ["t", "a"], size=2).collect()]
    assert got == [(0.0, [1.0, 2.0], [1.0]), (0.0, [0.0, 0.0], [0.0, 0.0]), (2.5, [0.0, 0.0], [3.0])]


def test_no_single_task_and_no_nested_loop_on_big_inputs(spark, sf):
    parts_, platforms = b.parts(spark, sf), b.platforms(spark, sf)
    gold = b.gold(spark, sf, platforms)
    lp = supply.lp_table(parts_, platforms, gold)
    frames = {
        "gold": gold,
        "lp": lp,
        "plan": supply.Shipping(parts_, platforms, gold).plan,
        "parts": tickets.required_parts(gold, parts_),
        "arcs": routes.route_arcs(b.fixture_shipments(parts_, platforms, gold), parts_, platforms),
    }
    for name, frame in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        # One task may see counts (of slices, of sites), never rows: what it reads comes out of an aggregate.
        lines = plan.splitlines()
        for at, line in enumerate(lines):
            if "SinglePartition" in line:
                below = [x for x in lines[at + 1 :] if re.search("Aggregate|Scan|Join", x)]
                assert "Aggregate" in below[0], (name, below[0])


def test_products_without_a_route_are_reported(spark):
    asked = spark.createDataFrame([("p", "d1", "h1", 1), ("p", "d2", "h2", 1), ("q", "d2", "h2", 1)], "type string, designator_id string, lane string, demand bigint")
    stock = spark.createDataFrame([("p", "s1", 0), ("p", "s2", 9), ("q", "s2", 9)], "type string, stock_location_id string, supply int")
    cost = spark.createDataFrame([("s1", "h1", 1.0), ("s2", "h2", 1.0)], "stock_location_id string, lane string, cost double")
    plan, _ = transport.shipments(asked, stock, cost)
    assert rows(supply.infeasible_products(asked, stock, staged(plan))) == [("p", 9, 2)]
