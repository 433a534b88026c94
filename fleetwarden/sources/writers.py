"""Sinks: overwritten folders and tables, time-ordered files and keyed feature tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.quality import key_report
from fleetwarden.session import new_folder

#: Rows that a task sorts for a time-ordered file, and slices that such a write plans at most.
SLICE_ROWS, MOST_SLICES = 1_000_000, 500


def overwrite_folder(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a Parquet folder; `files` fixes the number of files."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)


def overwrite_time_ordered(df: DataFrame, path: str, files: int, time: str = "timestamp") -> None:
    """Replace a Parquet folder whose files hold consecutive, sorted stretches of time.

    A file of many rows is not sorted in one task: slices of about SLICE_ROWS rows are sorted and stored, and the task of
    a file reads its slices one after another. Rows of one time share a slice, so a time that most rows hold is still
    sorted in one task, which spills.
    """
    slices = min(-(-df.count() // SLICE_ROWS), MOST_SLICES)
    ranged = df.repartitionByRange(max(files, slices), time).sortWithinPartitions(time)
    (_joined_slices(ranged, files) if slices > files else ranged).write.mode("overwrite").parquet(path)


def _joined_slices(ranged: DataFrame, files: int) -> DataFrame:
    """The partitions of a frame stored as they are, then joined in their order to `files` partitions of about equal rows."""
    spark, folder = ranged.sparkSession, new_folder(ranged.sparkSession, "slices")
    ranged.withColumn("_slice", F.spark_partition_id()).write.parquet(folder)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    # One row a slice, MOST_SLICES at most.
    counted = spark.read.parquet(folder).groupBy("_slice", name.alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, before, stretches = sum(r["n"] for r in counted), 0, {}
    for part in sorted(counted):
        stretches.setdefault((2 * before + part["n"]) * files // (2 * total), []).append(part["file"])
        before += part["n"]
    read = lambda file: spark.read.schema(ranged.schema).parquet(f"{folder}/{file}")
    # One partition reads its parts in the order of the union. A union of nothing but single partitions is a single
    # partition itself, so an end that holds no row goes along.
    end = spark.read.parquet(folder).filter(F.col("_slice") < 0).select(*ranged.columns)
    return reduce(DataFrame.union, [*[reduce(DataFrame.union, map(read, s)).coalesce(1) for s in stretches.values()], end])


def overwrite_by_day(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Replace a folder partitioned by day, so that time filters prune it; hot days are split into several files."""
    dated = df.withColumn("day", F.to_date(F.timestamp_seconds(time)))
    dated.repartitionByRange("day", time).write.mode("overwrite").partitionBy("day").parquet(path)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a managed table, its schema included."""
    df.write.mode("overwrite").saveAsTable(name)


def overwrite_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Replace a managed table laid out by key: `buckets` buckets, each sorted, in one file a bucket.

    Tables of one bucket count join and group on the keys without an exchange. Rows are dealt to their buckets before the
    write, so a table has `buckets` files however many tasks made the rows.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def write_feature_table(df: DataFrame, name: str, keys: list[str], folder: str) -> DataFrame:
    """Replace a feature table of the catalog and read it back; its versions lie in `folder`, one folder each.

    The new rows are stored beside the old ones and checked first: where the key is null or repeated, the old table
    stays. Then the table's entry in the catalog is pointed at them, so a write that dies leaves the old table whole
    and a reader sees one version or the other. Rows of other columns replace the entry. Old versions stay for the
    readers that have them open, until the owner of the folder clears them.
    """
    spark, version = df.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(version)
    rows = spark.read.schema(df.schema).parquet(version)
    report = key_report(rows, keys).first()
    if report["repeated_keys"] or report["null_key_rows"]:
        raise ValueError(f"{keys} is not a key: {report.asDict()}")
    columns = [(f.name, f.dataType) for f in df.schema]
    there = spark.catalog.tableExists(name)
    if there and [(f.name, f.dataType) for f in spark.table(name).schema] == columns:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    else:
        if there:
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, version, "parquet", df.schema)
    spark.catalog.refreshTable(name)
    return spark.table(name)
