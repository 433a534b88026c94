"""Sensor statistics per unit and time bucket, and numeric summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.temporal import time_bucket
from fleetwarden.operators.spread import gathered
from fleetwarden.schemas import PERCENTILES, SENSORS


def statistic_columns(sensors=SENSORS, probabilities=PERCENTILES, energy: str = "energy") -> list[Column]:
    return [
        F.avg(energy).alias("avg_energy"),
        *[F.stddev_pop(s).alias(f"std_{s}") for s in sensors],
        *[F.percentile_approx(s, list(probabilities)).alias(f"percentiles_{s}") for s in sensors],
    ]


def sensor_statistics(
    readings: DataFrame,
    keys: tuple[str, ...] = ("turbine_id",),
    sensors=SENSORS,
    grain: str = "hour",
    probabilities=PERCENTILES,
) -> DataFrame:
    """Average energy, population deviation and percentiles of each sensor per key and bucket.

    The readings of a key and bucket are brought near each other first (`gathered`), then reduced inside each task, so
    that sketches are shuffled once a group and a unit that holds most of the readings shrinks where its rows lie.
    """
    near = gathered(readings.withColumn("_bucket", time_bucket("timestamp", grain)), [*keys, "_bucket"])
    grouped = near.groupBy(*keys, F.col("_bucket").alias("hourly_timestamp"))
    return grouped.agg(*statistic_columns(sensors, probabilities))


def numeric_summary(df: DataFrame, columns: list[str], accuracy: int = 100_000) -> DataFrame:
    """count, mean, stddev, min, quartiles and max, one row per column, in one pass.

    A quartile's rank is off by at most rows / accuracy.
    """
    aggs = []
    for c in columns:
        quartiles = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.get(quartiles, 0).cast("double").alias("p25"),
                F.get(quartiles, 1).cast("double").alias("p50"),
                F.get(quartiles, 2).cast("double").alias("p75"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"s_{c}")
        )
    packed = df.agg(*aggs)
    return packed.select(F.inline(F.array(*[F.col(f"s_{c}") for c in columns])))
