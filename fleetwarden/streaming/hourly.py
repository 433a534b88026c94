"""Hourly statistics kept current by a stateful aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwarden.operators.partials import final_statistics, merge_partials, partial_statistics
from fleetwarden.session import exists


def hourly_state(
    stream: DataFrame, keys: list[str], time: str, aggs: list[Column], delay: str = "1 day", grain: str = "1 hour"
) -> DataFrame:
    """Aggregates per key and event-time window; rows later than the delay are left to the batch recompute.

    The engine drops these without a count; HourlyPartials keeps and counts them.
    """
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, grain).alias("_w"), *keys)
        .agg(*aggs)
        .withColumn("hourly_timestamp", F.col("_w.start"))
        .drop("_w")
    )


def upsert_to(stats: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch stores the hours it touched under its own batch number.

    A batch that is run again after a failure replaces its own folder only, so the table stays exact.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    return writer.trigger(availableNow=True).start()


def current_hours(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of every (key, hour)."""
    newest = W.partitionBy(*keys, "hourly_timestamp").orderBy(F.col("batch").desc())
    return stored.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", "batch")


def append_closed(stats: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Only hours the watermark has closed, each written once."""
    writer = stats.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


PASSED = "rows bigint, late bigint, high timestamp"


class HourlyPartials:
    """Hourly statistics as stored partials of each micro-batch, with the late rows kept aside and counted.

    A row is late if its time is before the newest time of earlier batches less the delay, or missing. Partials, late rows
    and one row of counts are stored under the batch number, so a batch that is run again replaces its own. Nothing is
    dropped, no state is kept between batches, and an hour stays open for ever: what comes late adds its own partial.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], time: str, sensors: list[str], delay: str = "1 day"):
        self.spark, self.path, self.keys, self.time, self.sensors, self.delay = spark, path, keys, time, sensors, delay

    def _partials(self, rows: DataFrame, *more: str) -> DataFrame:
        hour = F.date_trunc("hour", self.time).alias("hourly_timestamp")
        return partial_statistics(rows, [*self.keys, hour, *more], self.sensors)

    def _high(self, before: int):
        """The newest time of earlier batches; each batch carries it on, so one folder is read however many there are."""
        last = f"{self.path}/batches/batch={before - 1}"
        if exists(self.spark, last):
            return self.spark.read.schema(PASSED).parquet(last).first()["high"]
        if not exists(self.spark, f"{self.path}/batches"):
            return None
        # A batch number was left out.
        return self.batches().filter(F.col("batch") < before).agg(F.max("high")).first()[0]

    def store(self, batch: DataFrame, number: int) -> None:
        high = self._high(number)
        mark = F.lit(high) - F.expr(f"INTERVAL {self.delay}") if high is not None else F.lit(None).cast("timestamp")
        late = F.col(self.time).isNull() | F.coalesce(F.col(self.time) < mark, F.lit(False))
        rows = batch.withColumn("_late", late).persist()  # read three times
        try:
            put = lambda df, name: df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={number}")
            put(rows.filter("_late").drop("_late"), "late")
            put(self._partials(rows.filter("NOT _late")), "partials")
            newest = F.greatest(F.max(self.time), F.lit(high).cast("timestamp")).alias("high")
            counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"), newest)
            # Written last: a batch whose counts are there is whole.
            put(counts.coalesce(1), "batches")
        finally:
            rows.unpersist()

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.store)
        return writer.trigger(availableNow=True).start()

    def batches(self) -> DataFrame:
        """One row a batch: rows, late rows, newest time up to it."""
        return self.spark.read.schema(f"{PASSED}, batch int").parquet(f"{self.path}/batches")

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/late")

    def statistics(self, with_late: bool = True) -> DataFrame:
        """The hours so far; with the late rows they equal one computation over everything."""
        stored = self.spark.read.parquet(f"{self.path}/partials")
        if with_late:
            stored = stored.unionByName(self._partials(self.late().filter(F.col(self.time).isNotNull()), "batch"))
        keys = [*self.keys, "hourly_timestamp"]
        return final_statistics(merge_partials(stored, keys, "batch"), keys)
