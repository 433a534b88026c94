import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetwarden.operators import stats
from fleetwarden.schemas import READINGS, SENSORS


def reading(ts, unit, value, label="ok", energy=1.0, c=None):
    return (ts, value, value, c, value, value, value, energy, unit, label)


def test_hour_statistics(spark):
    data = [reading(3600, "u", 1.0), reading(7199, "u", 3.0), reading(7200, "u", 9.0), reading(3601, "v", 4.0)]
    out = {(r["turbine_id"], r["hourly_timestamp"]): r for r in stats.sensor_statistics(
        spark.createDataFrame(data, READINGS)).collect()}
    first = out["u", dt.datetime(1970, 1, 1, 1)]
    assert first["std_sensor_A"] == 1.0 and first["percentiles_sensor_A"] == [1.0, 1.0, 3.0, 3.0, 3.0]
    assert first["std_sensor_C"] is None and first["percentiles_sensor_C"] is None
    assert out["u", dt.datetime(1970, 1, 1, 2)]["std_sensor_A"] == 0.0
    assert len(out) == 3


def test_two_labels_in_one_hour_make_two_rows(spark):
    data = [reading(0, "u", 1.0, "ok"), reading(1, "u", 2.0, "sensor_A")]
    df = spark.createDataFrame(data, READINGS)
    assert stats.sensor_statistics(df, ("turbine_id", "abnormal_sensor")).count() == 2
    assert stats.sensor_statistics(df).count() == 1


def test_null_energy_is_skipped(spark):
    data = [reading(0, "u", 1.0, energy=None), reading(1, "u", 2.0, energy=4.0)]
    assert stats.sensor_statistics(spark.createDataFrame(data, READINGS)).first()["avg_energy"] == 4.0


def test_hot_unit_is_reduced_before_the_shuffle(spark):
    hot = spark.range(20000).select(
        (F.col("id") % 7200).alias("timestamp"),
        *[F.rand(1).alias(s) for s in SENSORS],
        F.lit(1.0).alias("energy"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("turbine_id"),
        F.lit("ok").alias("abnormal_sensor"),
    )
    df = stats.sensor_statistics(hot)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_percentile_approx") > plan.index("Exchange hashpartitioning")
    got = df.filter("turbine_id = 'hot'").agg(F.count("*")).first()[0]
    assert got == 2


def test_summary(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(1, 6)], "x double, y double")
    out = {r["column"]: r for r in stats.numeric_summary(df, ["x", "y"]).collect()}
    assert (out["x"]["p25"], out["x"]["p50"], out["x"]["p75"], out["x"]["mean"]) == (2.0, 3.0, 4.0, 3.0)
    assert out["y"]["count"] == 0 and out["y"]["mean"] is None
    assert out["x"]["stddev"] == pytest.approx(1.5811388)


def test_readings_are_near_each_other_before_they_are_reduced(spark):
    df = stats.sensor_statistics(spark.createDataFrame([reading(3600, "u", 1.0)], READINGS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Top down: rows are dealt by a hash of their group below the partial aggregate, groups above it.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.rindex("Exchange hashpartitioning(_near") > plan.index("partial_percentile_approx")


def test_a_large_group_is_split_between_tasks(spark):
    from fleetwarden.operators.spread import gathered

    rows_ = spark.range(400_000, numPartitions=16).select(F.lit(1).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        tasks = len(gathered(rows_, ["k"]).groupBy(F.spark_partition_id()).agg(F.max("v")).collect())
    finally:
        spark.conf.unset(size)
    assert tasks > 4
