"""Explicit schemas of the input tables and the fixed reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Sensor columns, percentile probabilities, failure shares in percent.
SENSORS = ("sensor_A", "sensor_B", "sensor_C", "sensor_D", "sensor_E", "sensor_F")
PERCENTILES = (0.1, 0.3, 0.6, 0.8, 0.95)
FAILURE_SHARES = (
    ("sensor_C", 30),
    ("sensor_D", 25),
    ("sensor_A", 20),
    ("sensor_B", 15),
    ("sensor_E", 7),
    ("sensor_F", 3),
)
# Impact of each sensor.
IMPACT = (
    ("sensor_F", "high"),
    ("sensor_A", "moderate"),
    ("sensor_B", "moderate"),
    ("sensor_E", "moderate"),
    ("sensor_C", "low"),
    ("sensor_D", "low"),
)
# Fault, maintenance_type, operable, ttr (hours).
MAINTENANCE_ROWS = (
    ("sensor_A", "Intermediate Level", True, 8.0),
    ("sensor_B", "Intermediate Level", True, 10.5),
    ("sensor_C", "Organizational Level", True, 6.0),
    ("sensor_D", "Organizational Level", True, 5.0),
    ("sensor_E", "Intermediate Level", True, 12.0),
    ("sensor_F", "Depot Level", False, 24.0),
)
# Maintenance level -> priority.
PRIORITIES = (
    ("Organizational Level", "Routine"),
    ("Intermediate Level", "Urgent"),
    ("Depot Level", "CASREP"),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_D, _S, _L, _I, _B = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()

READINGS = _struct(
    ("timestamp", _L),
    *((s, _D) for s in SENSORS),
    ("energy", _D),
    ("turbine_id", _S),
    ("abnormal_sensor", _S),
)
PLATFORMS = _struct(("designator", _S), ("home_location", _S), ("lat", _D), ("long", _D))
PLATFORMS_UNDERWAY = _struct(
    ("designator", _S),
    ("home_location", _S),
    ("lat", _D),
    ("long", _D),
    ("underway_simulated", _B),
    ("sim_lat", _D),
    ("sim_lon", _D),
    ("sim_distance_mi", _D),
    ("sim_bearing_deg", _D),
)
PARTS = _struct(
    ("NSN", _S),
    ("type", _S),
    ("width", _I),
    ("height", _I),
    ("weight", _I),
    ("cost", _D),
    ("production_time", _I),
    ("sensors", T.ArrayType(_S)),
    ("stock_location", _S),
    ("stock_location_id", _S),
    ("lat", _D),
    ("long", _D),
    ("inventory_level", _I),
    ("provisioning_time", _I),
)
MAINTENANCE = _struct(("fault", _S), ("maintenance_type", _S), ("operable", _B), ("ttr", T.FloatType()))
EVENTS = _struct(
    ("event_id", _L),
    ("ts", T.TimestampNTZType()),
    ("user_id", _L),
    ("event_type", _S),
    ("value", _D),
    ("props", _S),
)


def maintenance_actions(spark: SparkSession) -> DataFrame:
    """The six-row fault -> maintenance action table."""
    return spark.createDataFrame(list(MAINTENANCE_ROWS), MAINTENANCE)


def sensor_impact(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(IMPACT), _struct(("sensor", _S), ("impact", _S)))
