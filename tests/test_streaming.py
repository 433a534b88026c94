import datetime as dt
import os

from conftest import rows
from pyspark.sql import functions as F

from fleetwarden.operators.quality import Expectation
from fleetwarden.operators.stats import statistic_columns
from fleetwarden.plans import bindings as b
from fleetwarden.streaming import hourly, ingest

SCHEMA = "turbine_id string, event_time timestamp, energy double"


def drop(spark, folder, data, name):
    """One landing file; renamed in by Spark's own commit, its time set so that drops stay in order."""
    path = os.path.join(folder, name)
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(path)
    return path


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def test_ingest_takes_each_file_once_and_restarts(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    rules = [Expectation("positive", "energy > 0", drop=True), Expectation("small", "energy < 100")]
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        return ingest.ingest_files(spark, landing, table, state, schema, rules, 1)

    os.makedirs(landing)
    drop(spark, landing, [("u", at(0), 1.0), ("u", at(1), -1.0), ("u", at(2), None)], "a")
    first = run()
    assert first["positive"] == 2 and first["rows"] == 3 and first["small"] == 1
    drop(spark, landing, [("v", at(3), 500.0)], "b")
    second = run()
    assert second["rows"] == 1 and second["small"] == 1
    assert rows(spark.read.parquet(table).select("turbine_id", "energy")) == [("u", 1.0), ("v", 500.0)]
    assert run() == {}
    totals = {r["rule"]: (r["rows"], r["violations"]) for r in ingest.expectation_totals(spark, f"{table}_metrics").collect()}
    assert totals == {"positive": (4, 2), "small": (4, 2), "dropped": (4, 2)}


def test_files_of_other_types_and_columns_lose_nothing(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    for frame in (
        spark.createDataFrame([(1, 2.0)], "id int, v double"),
        spark.createDataFrame([(2, "x")], "id int, v string"),
        spark.createDataFrame([(3, 3.0, "n")], "id int, v double, note string"),
        spark.createDataFrame([(4,)], "id int"),
    ):
        frame.coalesce(1).write.mode("append").parquet(landing)
    target = spark.createDataFrame([], "id int, v double").schema
    ingest.ingest_files(spark, landing, table, state, target)
    got = rows(spark.read.parquet(table).select("id", "v", "_rescued_data"))
    assert got == [(1, 2.0, None), (2, None, '{"v":"x"}'), (3, 3.0, '{"note":"n"}'), (4, None, None)]


def test_hourly_state_equals_the_batch(spark, sf, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    events = b.events(spark, sf).select("turbine_id", "event_time", "energy")
    events.repartitionByRange(4, "event_time").write.parquet(landing)
    aggs = statistic_columns(sensors=["energy"])
    stream = ingest.file_stream(spark, landing, events.schema, 1)
    kept = hourly.hourly_state(stream, ["turbine_id"], "event_time", aggs, delay="60 days")
    hourly.upsert_to(kept, table, state).awaitTermination()
    assert len([d for d in os.listdir(table) if d.startswith("batch=")]) > 1
    batch = events.groupBy("turbine_id", F.date_trunc("hour", "event_time").alias("hourly_timestamp")).agg(*aggs)
    columns = ["turbine_id", "hourly_timestamp", "percentiles_energy", F.round("avg_energy", 9), F.round("std_energy", 9)]
    got = hourly.current_hours(spark.read.parquet(table), ["turbine_id"])
    assert rows(got.select(*columns)) == rows(batch.select(*columns))


def test_late_rows_are_left_out_beyond_the_watermark(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    os.makedirs(landing)
    schema = spark.createDataFrame([], SCHEMA).schema
    aggs = [F.avg("energy").alias("avg_energy"), F.count(F.lit(1)).alias("n")]

    def run():
        stream = ingest.file_stream(spark, landing + "/*", schema, 1)
        stats = hourly.hourly_state(stream, ["turbine_id"], "event_time", aggs, delay="10 minutes")
        hourly.append_closed(stats, table, state).awaitTermination()

    drop(spark, landing, [("u", at(5), 1.0), ("u", at(200), 1.0)], "a")
    run()
    drop(spark, landing, [("u", at(6), 9.0), ("u", at(201), 3.0), ("u", at(400), 1.0)], "b")
    run()
    got = {(r["hourly_timestamp"], r["avg_energy"], r["n"]) for r in spark.read.parquet(table).collect()}
    assert got == {(at(0), 1.0, 1), (at(180), 2.0, 2)}
