"""The test tables seen as fleet tables.

lineitem holds the readings (a unit is a supplier's line number, a ship day is a 15-second tick), customer the
platforms (nation x market segment), region the stock sites, part the spare parts and their inventory.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.geo import haversine_km
from fleetwarden.operators.joins import join_dimension, pair_grid
from fleetwarden.operators.ranking import cumulative_class
from fleetwarden.operators.scoring import placeholder_prediction
from fleetwarden.plans import gold as gold_plan
from fleetwarden.plans import silver, supply
from fleetwarden.plans.platforms import platform_dimension, unit_metadata
from fleetwarden.schemas import FAILURE_SHARES, SENSORS, maintenance_actions
from fleetwarden.session import pin, staged

BASE_SECONDS = 1_704_049_200  # 2023-12-31 19:00 UTC
TICK_SECONDS = 15
LINES = 7
HEALTHY_SHARE = 0.98
# Fixed values of the test tables: nation names, market segments; sites and ports are numbered.
NATIONS = (
    "ALGERIA", "ARGENTINA", "BRAZIL", "CANADA", "EGYPT", "ETHIOPIA", "FRANCE", "GERMANY", "INDIA", "INDONESIA", "IRAN",
    "IRAQ", "JAPAN", "JORDAN", "KENYA", "MOROCCO", "MOZAMBIQUE", "PERU", "CHINA", "ROMANIA", "SAUDI ARABIA", "VIETNAM",
    "RUSSIA", "UNITED KINGDOM", "UNITED STATES",
)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SITE_IDS = [f"supply_{i}" for i in range(1, 6)]
PORT_IDS = [f"home_{i}" for i in range(1, len(NATIONS) + 1)]
DESIGNATOR_IDS = [
    int(hashlib.md5(f"{n} {s}".encode()).hexdigest()[:15], 16) for n in NATIONS for s in SEGMENTS
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(os.path.join(sf, f"{name}.parquet"))


def _unit(supplier: str, line: str) -> Column:
    return F.concat(F.lit("T"), F.col(supplier).cast("string"), F.lit("-"), F.col(line).cast("string"))


def _ordinal(supplier: str, line: str) -> Column:
    return F.col(supplier) * LINES + F.col(line) - 1


def label_of(ordinal: Column, unit_count: Column) -> Column:
    """Units past 70% of the fleet carry a fault class by their number mod 100; the others are ok."""
    return F.when(ordinal * 10 > unit_count * 7, cumulative_class(F.pmod(ordinal, F.lit(100)), FAILURE_SHARES)).otherwise(
        "ok"
    )


def readings(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    day = F.datediff("l_shipdate", F.lit("1995-01-01").cast("date"))
    columns = [
        (F.lit(BASE_SECONDS) + day * TICK_SECONDS).cast("bigint").alias("timestamp"),
        F.col("l_quantity").alias("sensor_A"),
        (F.col("l_discount") * 100).alias("sensor_B"),
        F.nullif(F.col("l_tax") * 100, F.lit(0.0)).alias("sensor_C"),
        (F.col("l_extendedprice") / 1000).alias("sensor_D"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("sensor_E"),
        (F.col("l_quantity") * F.col("l_discount")).alias("sensor_F"),
        (F.col("l_extendedprice") - 20000).alias("energy"),
        _unit("l_suppkey", "l_linenumber").alias("turbine_id"),
    ]
    if labelled:
        fleet = table(spark, sf, "supplier").agg(F.count(F.lit(1)) * LINES).scalar()
        columns.append(label_of(_ordinal("l_suppkey", "l_linenumber"), fleet).alias("abnormal_sensor"))
    return lines.select(*columns)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Current readings after the drop rule."""
    return silver.current_bronze(readings(spark, sf, labelled=False))


def sensor_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.sensor_silver(bronze(spark, sf))


def raw_platforms(spark: SparkSession, sf: str) -> DataFrame:
    owners = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nations = table(spark, sf, "nation")
    named = join_dimension(owners.withColumnRenamed("c_nationkey", "n_nationkey"), nations, "n_nationkey")
    return named.select(
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("designator"),
        F.col("n_name").alias("home_location"),
        (F.col("n_nationkey") * 5 - 60).cast("double").alias("lat"),
        (F.col("n_nationkey") * 14 - 170).cast("double").alias("long"),
    )


def platforms(spark: SparkSession, sf: str) -> DataFrame:
    """The platform table, stored once: later steps check its size and join it several times."""
    return staged(platform_dimension(raw_platforms(spark, sf)))


def units(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.explode(F.sequence(F.lit(1), F.lit(LINES))).alias("line")
    each = table(spark, sf, "supplier").select("s_suppkey", lines)
    return each.select(_unit("s_suppkey", "line").alias("turbine_id"), _ordinal("s_suppkey", "line").alias("_ordinal"))


def platform_meta(spark: SparkSession, sf: str, platforms_: DataFrame | None = None) -> DataFrame:
    """One row per unit with its platform's columns."""
    owners = platforms_ if platforms_ is not None else platforms(spark, sf)
    meta = unit_metadata(owners, units(spark, sf), F.col("_ordinal")).drop("_ordinal")
    return silver.platform_silver(meta)


def stock(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_name").alias("stock_location"),
        F.concat(F.lit("supply_"), (F.col("r_regionkey") + 1).cast("string")).alias("stock_location_id"),
        (F.col("r_regionkey") * 25 - 60).cast("double").alias("lat"),
        (F.col("r_regionkey") * 70 - 170).cast("double").alias("long"),
    )


def part_types(spark: SparkSession, sf: str) -> DataFrame:
    """One row per brand with its sensors."""
    number = F.expr("cast(substring(p_brand, 7) as int)")
    letter = lambda i: F.concat(F.lit("sensor_"), F.substring(F.lit("ABCDE"), F.pmod(i, F.lit(5)) + 1, 1))
    n = F.col("n")
    grouped = (
        table(spark, sf, "part")
        .groupBy("p_brand")
        .agg(
            F.max("p_size").alias("width"),
            F.min("p_size").alias("height"),
            F.count(F.lit(1)).cast("int").alias("weight"),
            F.min("p_retailprice").alias("cost"),
        )
        .withColumn("n", number)
    )
    sensors = (
        F.when(n % 5 == 0, F.array(F.lit("sensor_F")))
        .when(n % 2 == 0, F.array(letter(n)))
        .otherwise(F.array(letter(n), letter(n + 1)))
    )
    return grouped.select(
        F.concat(F.lit("NSN-"), n.cast("string")).alias("NSN"),
        F.col("p_brand").alias("type"),
        "width",
        "height",
        "weight",
        "cost",
        (n + 30).alias("production_time"),
        sensors.alias("sensors"),
    )


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Parts on hand per brand and site."""
    site = F.concat(F.lit("supply_"), (F.pmod("p_partkey", F.lit(5)) + 1).cast("string"))
    on_hand = F.count_if(F.col("p_size") % 5 < 2).cast("int")
    parts_ = table(spark, sf, "part").select(F.col("p_brand").alias("type"), site.alias("stock_location_id"), "p_size")
    return parts_.groupBy("type", "stock_location_id").agg(
        on_hand.alias("inventory_level"), F.pmod(F.max("p_size"), F.lit(6)).alias("provisioning_time")
    )


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts x sites grid with the inventory of each cell, stored once."""
    grid = pair_grid(part_types(spark, sf), stock(spark, sf))
    filled = grid.join(inventory(spark, sf), ["type", "stock_location_id"], "left").fillna(
        0, ["inventory_level", "provisioning_time"]
    )
    return staged(silver.parts_silver(filled))


def scorer() -> Column:
    return placeholder_prediction(
        "turbine_id", F.unix_timestamp("hourly_timestamp"), healthy=HEALTHY_SHARE, faults=SENSORS
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return gold_plan.current_predictions(sensor_silver(spark, sf), platform_meta(spark, sf), scorer())


def gold(
    spark: SparkSession, sf: str, platforms_: DataFrame | None = None, latest_only: bool = False
) -> DataFrame:
    return gold_plan.status_gold(
        sensor_silver(spark, sf),
        platform_meta(spark, sf, platforms_),
        maintenance_actions(spark),
        scorer(),
        latest_only,
    )


def fixture_shipments(parts_: DataFrame, platforms_: DataFrame, gold_: DataFrame) -> DataFrame:
    """A shipment table that plain SQL can also state: each demand goes to its cheapest site, up to its supply.

    Designators of one port have the same cheapest site of a product, so sites are compared once a port.
    """
    ports = platforms_.select("designator_id", "home_location_id").distinct()
    asked = join_dimension(supply.demand(gold_, parts_).withColumnRenamed("parts", "type"), ports, "designator_id")
    cost = supply.shipping_cost(parts_, platforms_).select(
        F.col("stock_location").alias("stock_location_id"), F.col("homeport").alias("home_location_id"), F.col("distance").alias("cost")
    )
    best = (
        join_dimension(supply.supply(parts_), cost, "stock_location_id")
        .groupBy("type", "home_location_id")
        .agg(F.min(F.struct("cost", "stock_location_id", "supply")).alias("best"))
    )
    dealt = join_dimension(asked.filter("demand > 0"), best, ["type", "home_location_id"]).select(
        "type",
        F.col("best.stock_location_id").alias("stock_location_id"),
        "designator_id",
        F.least("demand", F.coalesce("best.supply", F.lit(0)).cast("bigint")).cast("int").alias("qty_shipped"),
    )
    sites = parts_.select("stock_location", "stock_location_id").distinct()
    names = platforms_.select("designator", "designator_id").distinct()
    return join_dimension(join_dimension(dealt, sites, "stock_location_id"), names, "designator_id")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The event stream as timed readings."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("turbine_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("energy"),
        "event_type",
        "props",
    )


def status_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Order windows as fault intervals on the readings' clock: 30 ticks from each order date, some a year."""
    fleet = table(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()
    day = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    start = F.lit(BASE_SECONDS) + day * TICK_SECONDS
    line = (F.pmod("o_custkey", F.lit(LINES)) + 1).cast("string")
    unit = F.concat_ws("-", F.concat(F.lit("T"), F.pmod("o_custkey", fleet).cast("string")), line)
    # Every fiftieth order leaves its window open for a year.
    length = F.when(F.col("o_orderkey") % 50 == 0, 31_536_000).otherwise(30 * 2 * TICK_SECONDS)
    return table(spark, sf, "orders").select(
        unit.alias("turbine_id"),
        start.cast("bigint").alias("start_time"),
        (start + length).cast("bigint").alias("end_time"),
        F.when(F.col("o_orderstatus") == "F", "ok").otherwise("sensor_A").alias("abnormal_sensor"),
    )


def customer_shipping(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(asked, stock, cost in km) with every customer at a place of its own: what a customer ordered of a brand is asked, and
    the regions hold a tenth more of it; of every seventh brand, half of it."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    brands = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("type"))
    asked = lines.join(orders, "o_orderkey").join(brands, "p_partkey").groupBy("type", F.col("o_custkey").alias("designator_id")).agg(
        F.count(F.lit(1)).alias("demand")
    )
    shares = F.element_at(F.array(*[F.lit(x) for x in (1, 2, 3, 1, 4)]), (F.col("r_regionkey") + 1).cast("int"))
    number = F.expr("cast(substring(type, 7) as int)")
    total = asked.groupBy("type").agg(F.sum("demand").alias("total"))
    supply = F.floor(F.col("total") * shares / F.when(number % 7 == 0, 22).otherwise(10)) + 1
    site = F.concat(F.lit("supply_"), (F.col("r_regionkey") + 1).cast("string"))
    stock_ = pair_grid(total, table(spark, sf, "region").select("r_regionkey")).select(
        "type", site.alias("stock_location_id"), supply.cast("bigint").alias("supply")
    )
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    places = table(spark, sf, "customer").select(
        key.alias("designator_id"),
        (nation * 5 - 60 + key * 7919 % 1000 / 250).alias("_plat"),
        (nation * 14 - 170 + key * 104729 % 1000 / 100).alias("_plon"),
    )
    sites = stock(spark, sf).select("stock_location_id", F.col("lat").alias("_slat"), F.col("long").alias("_slon"))
    km = haversine_km(F.col("_slat"), F.col("_slon"), F.col("_plat"), F.col("_plon"))
    return asked, stock_, pair_grid(places, sites).select("stock_location_id", "designator_id", km.alias("cost"))
