"""Part orders and work orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.tickets import part_order_number, priority, work_order_number
from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.ranking import number_distinct, number_rows


def part_orders(shipments: DataFrame) -> DataFrame:
    """Positive shipments with one order number per (site, designator), numbered in sorted order."""
    positive = shipments.filter(F.col("qty_shipped") > 0)
    pair = ["stock_location_id", "designator_id"]
    numbered = number_distinct(positive, pair, "_n")
    orders = numbered.withColumn("order_number", part_order_number(F.col("_n"))).drop("_n")
    return join_dimension(positive, orders, pair)


def required_parts_long(gold: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per unit, fault and stock number that serves it, with the hours of the fault.

    Units are folded to their faults first, so the parts meet one row per unit and fault, and no row carries a list.
    """
    faulty = gold.filter(F.col("prediction") != "ok").groupBy("turbine_id", "prediction")
    hours = faulty.agg(F.count(F.lit(1)).cast("int").alias("hours"))
    serving = parts.select("NSN", "type", F.explode("sensors").alias("prediction")).distinct()
    return join_dimension(hours, serving, "prediction").select("turbine_id", "prediction", "NSN", "type", "hours")


def required_parts(gold: DataFrame, parts: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """The long form as a sorted list per (turbine_id, prediction): each type once, or each stock number's type once
    per hour with keep_duplicates."""
    long = required_parts_long(gold, parts)
    keys = ["turbine_id", "prediction"]
    if not keep_duplicates:
        return long.groupBy(*keys).agg(F.sort_array(F.collect_set("type")).alias("parts_required"))
    repeated = long.withColumn("_copies", F.array_repeat("type", F.col("hours")))
    return repeated.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("_copies"))).alias("parts_required"))


def numbered_work(required: DataFrame) -> DataFrame:
    numbered = number_rows(required, ["turbine_id", "prediction"], "_n")
    return numbered.withColumn("work_order", work_order_number(F.col("_n"))).drop("_n")


def work_orders(gold: DataFrame, parts: DataFrame, orders: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Faulty gold rows with parts, work order, priority and the part orders of their designator.

    Designators without a part order have no work orders.
    """
    work = numbered_work(required_parts(gold, parts, keep_duplicates))
    collapsed = orders.groupBy("designator").agg(F.sort_array(F.collect_set("order_number")).alias("part_orders"))
    faulty = gold.filter(F.col("prediction") != "ok")
    return join_dimension(
        faulty.join(work, ["turbine_id", "prediction"]).withColumn("priority", priority(F.col("maintenance_type"))),
        collapsed,
        "designator",
    )
