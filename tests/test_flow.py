import pytest
from pyspark.sql import functions as F

from fleetwarden.plans import bindings as b
from fleetwarden.plans import flow
from fleetwarden.schemas import SENSORS
from fleetwarden.suite.queries import rounded


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    landing = str(tmp_path_factory.mktemp("landing"))
    b.readings(spark, sf).write.parquet(f"{landing}/incoming_data")
    b.readings(spark, sf).write.parquet(f"{landing}/historical_sensor_data")
    b.platform_meta(spark, sf).write.parquet(f"{landing}/meta")
    b.parts(spark, sf).write.parquet(f"{landing}/parts")
    path = str(tmp_path_factory.mktemp("lake"))
    return landing, flow.run_all(spark, landing, path, b.scorer())


def test_tables_equal_the_batch_plans(lake, spark, sf):
    _, made = lake
    silver, batch = rounded(made.read("sensor_silver")), rounded(b.sensor_silver(spark, sf))
    assert silver.count() == batch.count()
    assert silver.exceptAll(batch.select(silver.columns)).isEmpty()
    assert "day" in made.read("sensor_bronze").columns
    gold = made.read("ship_current_status_gold")
    assert set(SENSORS) & {r[0] for r in gold.select("prediction").distinct().collect()}
    assert gold.filter(F.col("prediction").isNull()).isEmpty()


def test_unexpected_fields_are_rescued_and_counted(spark, sf, tmp_path):
    landing = str(tmp_path / "landing")
    odd = b.readings(spark, sf).withColumn("note", F.when(F.col("energy") > 60000, "high"))
    odd.withColumn("sensor_B", F.col("sensor_B").cast("string")).write.parquet(f"{landing}/incoming_data")
    for folder in ("historical_sensor_data", "meta", "parts"):
        spark.createDataFrame([("x", 1)], "turbine_id string, extra int").write.parquet(f"{landing}/{folder}")
    made = flow.Lake(spark, str(tmp_path / "lake"))
    counts = flow.ingest(made, landing)["sensor_bronze"]
    high = odd.filter("energy > 60000").count()
    assert counts["correct_schema"] == high > 0 and counts["correct_energy"] == odd.filter("energy <= 0").count()
    kept = made.read("sensor_bronze")
    assert kept.filter("_rescued_data IS NOT NULL").count() == high
    assert kept.filter("sensor_B IS NULL").isEmpty()


def test_flow_reaches_the_tickets(lake):
    _, made = lake
    shipped = made.read("shipment_recommendations").filter("qty_shipped > 0")
    orders = made.read("ai_part_orders")
    assert orders.count() == shipped.count() > 0
    work = made.read("ai_work_orders")
    assert work.filter("prediction = 'ok'").isEmpty() and work.count() > 0
    assert made.read("route_arcs").filter("target_lat IS NULL OR source_lat IS NULL").isEmpty()


def test_a_second_run_without_new_files_changes_nothing(lake):
    landing, made = lake
    before = made.read("sensor_bronze").count()
    assert flow.ingest(made, landing)["sensor_bronze"] == {}
    assert made.read("sensor_bronze").count() == before


def test_upserted_hours_equal_the_full_refresh(lake, spark, sf):
    """A first pass over all files, then one late reading: only its hour changes."""
    _, made = lake
    full = rounded(b.sensor_silver(spark, sf))
    flow.upsert_silver(made)
    first = rounded(made.read("sensor_silver"))
    assert first.count() == full.count() and first.exceptAll(full.select(first.columns)).isEmpty()
    late = made.read("sensor_bronze").limit(1).withColumn("energy", F.lit(1e9)).drop("day", "_rescued_data")
    late.write.mode("append").parquet(f"{lake[0]}/incoming_data")
    flow.ingest(made, lake[0])
    flow.upsert_silver(made)
    again = rounded(made.read("sensor_silver"))
    assert again.count() == full.count()
    assert again.exceptAll(full.select(again.columns)).count() == 1
