"""Bronze rules and silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetwarden.operators.quality import Expectation, expect, not_null
from fleetwarden.operators.stats import sensor_statistics

CORRECT_SCHEMA = Expectation("correct_schema", "_rescued_data IS NULL")
CORRECT_ENERGY = Expectation("correct_energy", "energy IS NOT NULL AND energy > 0", drop=True)
CURRENT_RULES = [CORRECT_SCHEMA, CORRECT_ENERGY]
HISTORY_RULES = [CORRECT_SCHEMA]


def current_bronze(readings: DataFrame, observation=None) -> DataFrame:
    return expect(readings, CURRENT_RULES if "_rescued_data" in readings.columns else [CORRECT_ENERGY], observation)


def sensor_silver(bronze: DataFrame, **options) -> DataFrame:
    return expect(sensor_statistics(bronze, ("turbine_id",), **options), not_null("turbine_id", "hourly_timestamp"))


def historical_sensor_silver(bronze: DataFrame, **options) -> DataFrame:
    labelled = sensor_statistics(bronze, ("turbine_id", "abnormal_sensor"), **options)
    return expect(labelled, not_null("turbine_id", "hourly_timestamp"))


def training_dataset(history: DataFrame, **options) -> DataFrame:
    return historical_sensor_silver(history, **options)


def _clean(df: DataFrame, key: str) -> DataFrame:
    return expect(df.drop("_rescued_data"), not_null(key))


def platform_silver(meta: DataFrame) -> DataFrame:
    return _clean(meta, "turbine_id")


def parts_silver(parts: DataFrame) -> DataFrame:
    return _clean(parts, "NSN")


def maintenance_silver(actions: DataFrame) -> DataFrame:
    return _clean(actions, "fault")
