"""The whole flow, table by table: landing files to work orders and route arcs.

Each step reads stored tables and replaces its own, so a step can be run again on its own after a failure.
"""

from __future__ import annotations

import datetime
import os
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.operators.quality import Expectation
from fleetwarden.operators.scoring import placeholder_prediction
from fleetwarden.plans import gold, routes, silver, supply, tickets
from fleetwarden.schemas import MAINTENANCE, PARTS, READINGS, maintenance_actions
from fleetwarden.session import exists, pin, remove
from fleetwarden.streaming.ingest import each_batch_of_files, ingest_files

Scorer = Column | Callable[[DataFrame], DataFrame]

VERSIONS = "version string, made bigint"

# Landing folder -> bronze table, its schema (None: as the files say) and its rules.
BRONZE: dict[str, tuple[str, T.StructType | None, list[Expectation]]] = {
    "incoming_data": ("sensor_bronze", READINGS, silver.CURRENT_RULES),
    "historical_sensor_data": ("historical_sensor_bronze", READINGS, silver.HISTORY_RULES),
    "meta": ("ship_meta_bronze", None, []),
    "parts": ("parts_bronze", PARTS, []),
}


class Lake:
    """Tables as Parquet folders below one path.

    A replaced table is written as a new version beside the old one, then a pointer row names it; readers see the old
    version until that row is there, and a failed write leaves it in place. The version before stays for open readers.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = pin(spark), path

    def folder(self, table: str) -> str:
        return os.path.join(self.path, table)

    def _pointers(self, table: str) -> str:
        return self.folder(f"_versions/{table}")

    def versions(self, table: str) -> list[str]:
        """Version folders, the newest first; none for a table that only grows."""
        if not exists(self.spark, self._pointers(table)):
            return []
        rows = self.spark.read.schema(VERSIONS).parquet(self._pointers(table)).orderBy(F.desc("made")).collect()
        return [os.path.join(self.folder(table), r["version"]) for r in rows]

    def current(self, table: str) -> str:
        return next(iter(self.versions(table)), self.folder(table))

    def read(self, table: str) -> DataFrame:
        stored = self.spark.read.option("mergeSchema", "true").parquet(self.current(table))
        return stored.drop("batch", "silver_day")

    def replace(self, table: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        old, version = self.versions(table)[1:], f"v{uuid.uuid4().hex}"
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(os.path.join(self.folder(table), version))
        row = self.spark.createDataFrame([(version, time.time_ns())], VERSIONS)
        row.coalesce(1).write.mode("append").parquet(self._pointers(table))
        for folder in old:
            remove(self.spark, folder)
        return self.read(table)


def ingest_table(lake: Lake, landing: str, folder: str, files_per_trigger: int = 1000) -> dict[str, int]:
    """Append what is new in one landing folder to its bronze table; returns the expectation counts."""
    table, schema, rules = BRONZE[folder]
    return ingest_files(
        lake.spark,
        os.path.join(landing, folder),
        lake.folder(table),
        lake.folder(f"_state/{table}"),
        schema,
        rules,
        files_per_trigger,
        "timestamp",
    )


def ingest(lake: Lake, landing: str, files_per_trigger: int = 1000) -> dict[str, dict[str, int]]:
    """Append what is new in each landing folder to its bronze table; returns the expectation counts.

    Fields that do not fit the declared schema go to _rescued_data and are counted, not lost; files of one folder may
    differ from each other.
    """
    counts = {
        table: ingest_table(lake, landing, folder, files_per_trigger) for folder, (table, _, _) in BRONZE.items()
    }
    lake.replace("sensor_maintenance", maintenance_actions(lake.spark))
    return counts


def refresh_silver(lake: Lake) -> None:
    lake.replace("sensor_silver", _by_day(silver.sensor_silver(lake.read("sensor_bronze"))), "silver_day")
    history = lake.replace(
        "historical_sensor_silver", silver.historical_sensor_silver(lake.read("historical_sensor_bronze"))
    )
    lake.replace("turbine_training_dataset", history)
    lake.replace("ship_meta_silver", silver.platform_silver(lake.read("ship_meta_bronze")))
    lake.replace("parts_silver", silver.parts_silver(lake.read("parts_bronze")))
    actions = lake.spark.read.schema(MAINTENANCE).parquet(lake.current("sensor_maintenance"))
    lake.replace("maintenance_actions_silver", silver.maintenance_silver(actions))


def _by_day(stats: DataFrame) -> DataFrame:
    return stats.withColumn("silver_day", F.to_date("hourly_timestamp"))


def upsert_silver(lake: Lake, files_per_trigger: int = 1000) -> None:
    """sensor_silver from the new bronze files: only the days they touch are computed again and overwritten.

    An hour lies in one day, so a day's statistics follow from its own bronze partitions, however late a reading is.
    """
    bronze = lake.folder("sensor_bronze")

    def store(paths: list[str], number: int) -> None:
        days = sorted({m.group(1) for p in paths if (m := re.search(r"/day=([0-9-]+)/", p))})
        touched = lake.read("sensor_bronze").filter(F.col("day").isin([datetime.date.fromisoformat(d) for d in days]))
        fresh = _by_day(silver.sensor_silver(touched))
        if not lake.versions("sensor_silver"):
            lake.replace("sensor_silver", fresh, "silver_day")
            return
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("silver_day").parquet(lake.current("sensor_silver"))

    each_batch_of_files(lake.spark, bronze, lake.folder("_state/sensor_silver"), store, files_per_trigger)


def refresh_gold(lake: Lake, scorer: Scorer | None = None, latest_only: bool = False) -> None:
    scorer = scorer if scorer is not None else placeholder_prediction("turbine_id", "hourly_timestamp")
    scored = lake.replace(
        "current_status_predictions",
        gold.current_predictions(lake.read("sensor_silver"), lake.read("ship_meta_silver"), scorer, latest_only),
    )
    lake.replace("ship_current_status_gold", gold.with_maintenance(scored, lake.read("maintenance_actions_silver")))


def refresh_shipments(lake: Lake, cost: str = "rank") -> None:
    parts, meta = lake.read("parts_silver"), lake.read("ship_meta_silver")
    columns = ["designator", "designator_id", "home_location", "home_location_id", "lat", "long"]
    simulated = [c for c in ("sim_lat", "sim_lon") if c in meta.columns]
    platforms = lake.replace("platforms", meta.select(*columns, *simulated).distinct())
    lake.replace("shipping_cost", supply.shipping_cost(parts, platforms, cost))
    gold_table = lake.read("ship_current_status_gold")
    made = supply.Shipping(parts, platforms, gold_table, cost)
    lake.replace("transport_flows", made.flows)
    plan = lake.replace("transport_plan", made.plan)
    lake.replace("shipment_recommendations", supply.with_names(plan, parts, platforms))
    lake.replace("infeasible_products", supply.infeasible_products(made.asked, made.stock, plan))


def refresh_tickets(lake: Lake) -> None:
    orders = lake.replace("ai_part_orders", tickets.part_orders(lake.read("shipment_recommendations")))
    lake.replace(
        "ai_work_orders",
        tickets.work_orders(lake.read("ship_current_status_gold"), lake.read("parts_silver"), orders),
    )
    arcs = routes.route_arcs(
        lake.read("shipment_recommendations"), lake.read("parts_silver"), lake.read("platforms")
    )
    lake.replace("route_arcs", arcs)


def run_all(spark: SparkSession, landing: str, path: str, scorer: Scorer | None = None) -> Lake:
    lake = Lake(spark, path)
    ingest(lake, landing)
    refresh_silver(lake)
    refresh_gold(lake, scorer)
    refresh_shipments(lake)
    refresh_tickets(lake)
    return lake
