"""Joins that keep their shape when one key is hot or one side outgrows a broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
#: Finest to coarsest interval buckets differ by this factor, so an interval touches at most a few of its level.
LEVEL_FACTOR_LOG2 = 2


def salted_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi join with every key cut into `salts` parts: dim rows are repeated, facts rows are spread.

    A row's part follows from its content and its partition, so equal rows spread too and a retried task repeats it.
    """
    part = F.pmod(F.xxhash64(*facts.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    spread = facts.withColumn("_salt", part)
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join a few-keyed dimension.

    Adaptive execution broadcasts the dimension once its shuffled size is known to be within
    spark.sql.adaptive.autoBroadcastJoinThreshold and splits hot keys of a sort-merge join beyond. `salts` cuts every key into
    that many parts instead, for plans whose other operators keep adaptive execution from splitting.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("facts must be the preserved side")
    return salted_join(facts, dim, keys, how, salts) if salts else facts.join(dim, keys, how)


def member_join(items: DataFrame, owners: DataFrame, item: str, members: str, how: str = "inner") -> DataFrame:
    """Rows whose `item` is an element of the owner's `members` array: distinct explode, then an equi join."""
    flat = owners.withColumn(item, F.explode(F.array_distinct(members))).filter(F.col(item).isNotNull())
    return join_dimension(items, flat, item, how)


def pair_grid(left: DataFrame, right: DataFrame, cells: int = 16) -> DataFrame:
    """Every left row with every right row, as an equi join on a cell number.

    Each right row lives in one cell and each left row in all, so a pair is made exactly once and the work
    spreads over the cells. The result is the matrix itself, so its size is rows x rows by definition.
    """
    one_cell = right.withColumn("_cell", F.pmod(F.xxhash64(*right.columns), F.lit(cells)).cast("int"))
    all_cells = left.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    return all_cells.join(one_cell, "_cell").drop("_cell")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: list[str],
    point: str,
    start: str,
    end: str,
    width: int,
) -> DataFrame:
    """Points strictly inside an interval of the same key; all three columns are unix seconds.

    An interval with a null bound, or whose end is not after its start, holds no point; give open ones an end.

    Buckets of `width` seconds are the finest level, and each further level is four times as wide. An interval goes
    to the level that its length fills, once per bucket it touches there (three at most, whatever its length), and a
    point asks one bucket of every level in use. A hot key is cut along time, and the join stays an equi join.
    """
    step = lambda level: F.lit(width) * F.pow(F.lit(2), level * LEVEL_FACTOR_LOG2).cast("bigint")
    bucket_of = lambda c, level: F.floor(F.col(c) / step(level)).cast("bigint")
    level = F.ceil(F.greatest(F.log2((F.col(end) - F.col(start)) / width), F.lit(0.0)) / LEVEL_FACTOR_LOG2)
    leveled = intervals.filter(F.col(start) < F.col(end)).withColumn("_level", level.cast("int"))
    copies = leveled.withColumn(
        "_bucket", F.explode(F.sequence(bucket_of(start, F.col("_level")), bucket_of(end, F.col("_level"))))
    )
    top = leveled.agg(F.coalesce(F.max("_level"), F.lit(0))).scalar()
    marked = points.withColumn("_level", F.explode(F.sequence(F.lit(0), top))).withColumn(
        "_bucket", bucket_of(point, F.col("_level"))
    )
    inside = (F.col(start) < F.col(point)) & (F.col(point) < F.col(end))
    return marked.join(copies, [*on, "_level", "_bucket"]).filter(inside).drop("_level", "_bucket")


def modulo_assign(rows: DataFrame, ordinal: Column, owners: DataFrame, owner_ordinal: str) -> DataFrame:
    """Row j goes to owner j mod n; owners are numbered 0..n-1 in `owner_ordinal`."""
    n = owners.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    return join_dimension(rows.withColumn(owner_ordinal, F.pmod(ordinal, n)), owners, owner_ordinal).drop(
        owner_ordinal
    )


def label_crosstab(
    labelled: DataFrame, scored: DataFrame, key: str, label: str = "abnormal_sensor", prediction: str = "prediction"
) -> DataFrame:
    """Row counts per (label, prediction) of the many-to-many join on key, without making the joined rows."""
    left = labelled.groupBy(key, label).agg(F.count(F.lit(1)).alias("_l"))
    right = scored.groupBy(key, prediction).agg(F.count(F.lit(1)).alias("_r"))
    return left.join(right, key).groupBy(label, prediction).agg(F.sum(F.col("_l") * F.col("_r")).alias("n"))
