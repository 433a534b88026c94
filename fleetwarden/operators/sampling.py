"""Sampling and splits that repeat from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.keys import split_label, stable_number
from fleetwarden.operators.joins import join_dimension
from fleetwarden.session import staged


def bernoulli(df: DataFrame, fraction: float, key: list[str]) -> DataFrame:
    """Each row kept with the given probability, decided by its key."""
    return df.filter(F.pmod(stable_number(*key), F.lit(1_000_000)) < round(fraction * 1_000_000))


def with_split(df: DataFrame, key: list[str], shares: dict[str, float] | None = None, name: str = "split") -> DataFrame:
    return df.withColumn(name, split_label(shares or {"train": 0.6, "val": 0.2, "test": 0.2}, *key))


def example_readings(readings: DataFrame, label: str = "abnormal_sensor", unit: str = "turbine_id") -> DataFrame:
    """All readings of one example unit per label (the least unit key), by a join instead of a driver lookup."""
    chosen = staged(readings.groupBy(label).agg(F.min(unit).alias(unit)))
    return join_dimension(readings, chosen, [label, unit], "left_semi")
