"""Statistics that merge: stored partials of disjoint rows add up to the statistics of all rows.

A partial of a column is its count, mean and sum of squared deviations, and a quantile sketch for each sensor. A late
file then costs its own rows and one small row for each group it touches, not the rows that came before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.spread import gathered
from fleetwarden.schemas import PERCENTILES, SENSORS

#: Size of a quantile sketch: exact up to so many values, then ranks are off by about 1.3 in a hundred.
SKETCH = 200


def moments(column: str) -> Column:
    """Count, mean and sum of squared deviations of the values that are not null."""
    n = F.count(column)
    return F.struct(
        n.alias("n"), F.coalesce(F.avg(column), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(column) * n, F.lit(0.0)).alias("m2")
    )


def partial_statistics(rows: DataFrame, keys: list[str | Column], sensors=SENSORS, energy: str = "energy") -> DataFrame:
    """One partial for each group of keys: moments of energy and sensors, and a sketch of each sensor's values.

    The rows of a group are brought near each other first: a sketch of a few rows is larger than the rows.
    """
    key = lambda k: rows.select(k).columns[0]
    names = [f"_key_{i}" for i in range(len(keys))]
    keyed = gathered(rows.withColumns(dict(zip(names, [F.col(k) if isinstance(k, str) else k for k in keys]))), names)
    columns = list(dict.fromkeys([energy, *sensors]))
    sketches = [F.kll_sketch_agg_double(F.col(s).cast("double"), F.lit(SKETCH)).alias(f"sketch_{s}") for s in sensors]
    grouped = keyed.groupBy(*[F.col(n).alias(key(k)) for n, k in zip(names, keys)])
    return grouped.agg(*[moments(c).alias(f"moments_{c}") for c in columns], *sketches)


def _added(parts: Column) -> Column:
    """Moments of disjoint rows added up in their order; differences of means keep it stable for large means."""
    n = lambda a, b: a["n"] + b["n"]
    step = lambda a, b: b["mean"] - a["mean"]
    both = lambda a, b: F.struct(
        n(a, b).alias("n"),
        (a["mean"] + step(a, b) * b["n"] / n(a, b)).alias("mean"),
        (a["m2"] + b["m2"] + step(a, b) * step(a, b) * a["n"] * b["n"] / n(a, b)).alias("m2"),
    )
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, none, lambda a, b: F.when(b["n"] > 0, both(a, b)).otherwise(a))


def merge_partials(partials: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One partial for each group from its partials, added in the order of a column; the result merges further.

    A group has as many rows as files have touched it; merge and store again where these become many.
    """
    names = [c.removeprefix("moments_") for c in partials.columns if c.startswith("moments_")]
    sketched = [c for c in partials.columns if c.startswith("sketch_")]
    rows = F.array_sort(F.collect_list(F.struct(order, *[f"moments_{c}" for c in names])))
    merged = partials.groupBy(*keys).agg(rows.alias("_parts"), *[F.kll_merge_agg_double(c).alias(c) for c in sketched])
    added = [_added(F.col("_parts")[f"moments_{c}"]).alias(f"moments_{c}") for c in names]
    return merged.select(*keys, *added, *sketched)


def final_statistics(merged: DataFrame, keys: list[str], probabilities=PERCENTILES, energy: str = "energy") -> DataFrame:
    """The columns of sensor_statistics; a group without a value has null."""
    value = lambda c, field: F.when(F.col(f"moments_{c}.n") > 0, field)
    sensors = [c.removeprefix("sketch_") for c in merged.columns if c.startswith("sketch_")]
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    return merged.select(
        *keys,
        value(energy, F.col(f"moments_{energy}.mean")).alias("avg_energy"),
        *[value(s, F.sqrt(F.col(f"moments_{s}.m2") / F.col(f"moments_{s}.n"))).alias(f"std_{s}") for s in sensors],
        *[value(s, F.kll_sketch_get_quantile_double(f"sketch_{s}", wanted)).alias(f"percentiles_{s}") for s in sensors],
    )
