"""Append ingest of landing files with expectations.

A stream lists the files that have arrived; each micro-batch reads its own files, whatever their schemas, and stores the
rows and one row of expectation counts per rule under its batch number. A batch that is run again after a failure
replaces exactly what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.operators.quality import Expectation, expect
from fleetwarden.session import exists, pin
from fleetwarden.sources.readers import rescue

METRICS = "rule string, rows bigint, violations bigint"


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1000, glob: str | None = None
) -> DataFrame:
    """The rows of new Parquet files of one known schema as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def each_batch_of_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    store: Callable[[list[str], int], None],
    files_per_trigger: int = 1000,
    glob: str = "*.parquet",
) -> None:
    """Call store(paths, batch number) for the files that have arrived since the last run; contents are not read."""
    listed = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )

    def run(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # files_per_trigger bounds them
        if paths:
            store(paths, number)

    writer = listed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    writer.trigger(availableNow=True).start().awaitTermination()


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files whose schemas fit together, each with their merged schema; files that clash are separated."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError):  # schemas that do not merge come as either
        if len(paths) == 1:
            raise
        half = len(paths) // 2
        return [*schema_groups(spark, paths[:half]), *schema_groups(spark, paths[half:])]


def read_landing(spark: SparkSession, paths: list[str], schema: T.StructType | None) -> DataFrame:
    """Files of any schemas brought to one; what does not fit goes to _rescued_data. Without a schema all columns stay."""
    parts = [
        rescue(spark.read.schema(found).parquet(*group), schema or found) for found, group in schema_groups(spark, paths)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_files(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    schema: T.StructType | None,
    rules: list[Expectation] = (),
    files_per_trigger: int = 1000,
    day_of: str | None = None,
    glob: str = "*.parquet",
) -> dict[str, int]:
    """Append what is new to the table at path; returns this run's expectation counts.

    `day_of` names a column of unix seconds: the table is then partitioned by its day, so time filters prune. The counts
    of all runs stay in path + "_metrics", one row per batch and rule.
    """
    rules, metrics = list(rules), f"{path}_metrics"
    before = last_batch(spark, metrics)
    # Observations belong to a session of their own: a session that has had one can't be shipped inside a fitted model.
    apart = pin(spark.newSession())

    def store(paths: list[str], number: int) -> None:
        landed = read_landing(apart, paths, schema)
        # Counted while the rows are written: the files are read once. A batch that is run again counts the same.
        seen = Observation(f"expectations_{number}")
        rows = expect(landed, rules, seen)
        if day_of and day_of in rows.columns:
            dated = rows.withColumn("day", F.to_date(F.timestamp_seconds(day_of)))
            dated.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
        else:
            rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        counts = seen.get
        names = ["dropped", *[r.name for r in rules]]
        lines = [(name, counts.get("rows", 0), counts.get(name, 0)) for name in names]
        spark.createDataFrame(lines, METRICS).coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch={number}")

    each_batch_of_files(spark, folder, checkpoint, store, files_per_trigger, glob)
    totals = expectation_totals(spark, metrics, before).collect()
    return {"rows": totals[0]["rows"], **{r["rule"]: r["violations"] for r in totals}} if totals else {}


def _metrics(spark: SparkSession, metrics: str) -> DataFrame:
    if not exists(spark, metrics):
        return spark.createDataFrame([], f"{METRICS}, batch int")
    return spark.read.schema(f"{METRICS}, batch int").parquet(metrics)


def last_batch(spark: SparkSession, metrics: str) -> int:
    return _metrics(spark, metrics).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]


def expectation_totals(spark: SparkSession, metrics: str, after: int = -1) -> DataFrame:
    """rule, rows and violations, summed over the batches after the given one."""
    later = _metrics(spark, metrics).filter(F.col("batch") > after)
    return later.groupBy("rule").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))
