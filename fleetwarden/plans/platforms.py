"""Platform metadata: surrogate ids, home location ids and the unit mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.keys import surrogate_id
from fleetwarden.operators.joins import join_dimension, modulo_assign
from fleetwarden.operators.ranking import number_rows


def with_home_ids(platforms: DataFrame) -> DataFrame:
    """Distinct home locations are numbered in name order and joined back.

    The ports come as one sorted list from one aggregate with partial sets; a fleet has few of them.
    """
    ports = platforms.agg(F.array_sort(F.collect_set("home_location")).alias("_ports"))
    homes = ports.select(F.posexplode("_ports").alias("_n", "home_location")).select(
        "home_location", F.concat(F.lit("home_"), (F.col("_n") + 1).cast("string")).alias("home_location_id")
    )
    return join_dimension(platforms, homes, "home_location")


def platform_dimension(platforms: DataFrame) -> DataFrame:
    return with_home_ids(platforms).withColumn("designator_id", surrogate_id("designator"))


def unit_metadata(platforms: DataFrame, units: DataFrame, ordinal: Column) -> DataFrame:
    """Each unit gets platform (ordinal mod number of platforms), platforms taken in designator order."""
    numbered = number_rows(platforms, ["designator"], "_rn")
    owners = numbered.withColumn("_owner", F.col("_rn").cast("bigint") - 1).drop("_rn")
    return modulo_assign(units, ordinal, owners, "_owner")
