import random

from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwarden.functions import tickets
from fleetwarden.operators import ranking, reshape, sampling
from fleetwarden.schemas import FAILURE_SHARES


def test_ties_take_the_highest_place(spark):
    df = spark.createDataFrame([("s", "a", 5.0), ("s", "b", 5.0), ("s", "c", 9.0), ("t", "a", 1.0)], "s string, p string, d double")
    got = {(r["s"], r["p"]): r["r"] for r in ranking.rank_ties_last(df, ["s"], "d", "r").collect()}
    assert got == {("s", "a"): 1.0, ("s", "b"): 1.0, ("s", "c"): 2.0, ("t", "a"): 0.1}


def test_sliced_numbering_equals_a_window(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.hash("id").alias("v"), "id")
    sliced = ranking.number_rows(df, ["v", "id"], "n", slices=6)
    assert rows(sliced) == rows(df.withColumn("n", F.row_number().over(W.orderBy("v", "id"))))
    grouped = ranking.number_rows(df, ["v", "id"], "n", group=["k"], slices=6)
    assert rows(grouped) == rows(df.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("v", "id"))))


def test_sliced_numbering_with_null_groups(spark):
    df = spark.createDataFrame([(None if i % 2 else 1.5, i) for i in range(100)], "g double, i int")
    got = ranking.number_rows(df, ["i"], "n", group=["g"], slices=4)
    assert got.schema["n"].dataType.simpleString() == "bigint"
    assert rows(got) == rows(df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("i"))))


def test_running_total_keeps_null_groups_and_chunks(spark):
    df = spark.createDataFrame([(None, 1, 1, 5), (None, None, 2, 7), ("a", None, 3, 1), ("a", 2, 4, 2)], "g string, c int, i int, v int")
    got = {r["i"]: r["t"] for r in ranking.running_total(df, ["g"], "c", ["i"], F.col("v"), "t").collect()}
    assert got == {2: 7, 1: 12, 3: 1, 4: 3}


def test_running_total_equals_a_window(spark):
    rnd = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"u{i % 5}", i // 40, i, rnd.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(data, "u string, chunk int, i int, v int")
    got = ranking.running_total(df, ["u"], "chunk", ["i"], F.col("v"), "total")
    w = W.partitionBy("u").orderBy("chunk", "i").rowsBetween(W.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("total", F.sum("v").over(w)))


def test_dedup_keeps_every_hour_and_latest_keeps_one(spark):
    df = spark.createDataFrame([("u", 1, 7), ("u", 1, 5), ("u", 2, 9), ("v", 1, 3)], "turbine_id string, hourly_timestamp int, x int")
    assert rows(ranking.dedup_hour(df)) == [("u", 1, 5), ("u", 2, 9), ("v", 1, 3)]
    assert rows(ranking.latest_per_unit(df)) == [("u", 2, 9), ("v", 1, 3)]
    assert "WindowGroupLimit" in ranking.latest_per_unit(df)._jdf.queryExecution().executedPlan().toString()


def test_cumulative_class(spark):
    got = rows(spark.range(100).groupBy(ranking.cumulative_class(F.col("id"), FAILURE_SHARES).alias("c")).count())
    assert dict(got) == dict(FAILURE_SHARES)


def test_order_numbers_widen_instead_of_truncating(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n int")
    got = rows(df.select(tickets.part_order_number(F.col("n")), tickets.work_order_number(F.col("n"))))
    assert got == [("PR-000007", "AI-WO 007"), ("PR-1234567", "AI-WO 1234567")]


def test_best_row_and_snapshot(spark):
    runs = spark.createDataFrame([("a", 0.8), ("b", 1.0), ("c", 0.9)], "run string, f1 double")
    assert rows(ranking.best_row(runs, "f1")) == [("c", 0.9)]
    assert rows(ranking.latest_snapshot(runs, "f1")) == [("b", 1.0)]


def test_newest_named(spark):
    names = spark.createDataFrame([("x-2024-01-05_10:00:00",), ("y-2024-01-07_09:00:00",), ("none",)], "name string")
    pick = lambda day: ranking.newest_named(names, "name", F.lit(day).cast("date")).select("name", "age_days")
    assert rows(pick("2024-01-10")) == [("y-2024-01-07_09:00:00", 3)]
    assert rows(pick("2024-03-10")) == []


def test_pivot_and_back(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, 7.0)], "t string, d int, c double")
    wide = reshape.pivot_prefixed(df, ["t"], "d", F.max("c"), "Cost_")
    assert wide.columns == ["t", "Cost_1", "Cost_2"] and rows(wide) == [("a", 5.0, 6.0), ("b", 7.0, None)]
    long = reshape.unpivot_prefixed(wide, ["t"], "Cost_", "d", "c").dropna()
    assert rows(long) == [("a", "1", 5.0), ("a", "2", 6.0), ("b", "1", 7.0)]


def test_time_grid_and_fleet(spark):
    df = spark.createDataFrame([("u", 0, 25)], "u string, a bigint, b bigint")
    assert [r["timestamp"] for r in reshape.time_grid(df, "a", "b", 10).collect()] == [0, 10, 20]
    fleet = reshape.expand_fleet(spark.createDataFrame([("p",), ("q",)], "d string"), "d", 4)
    assert fleet.select("turbine_id").distinct().count() == 8


def test_sample_and_split_repeat(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    once, again = (sampling.bernoulli(d, 0.05, ["k"]) for d in (df, df.repartition(13)))
    assert rows(once) == rows(again) and 800 < once.count() < 1200
    shares = dict(rows(sampling.with_split(df, ["k"]).groupBy("split").count()))
    assert abs(shares["train"] - 12000) < 400 and abs(shares["val"] - 4000) < 300


def test_example_units(spark):
    df = spark.createDataFrame([("ok", "b", 1), ("ok", "a", 2), ("ok", "a", 3), ("x", "c", 4)], "abnormal_sensor string, turbine_id string, v int")
    assert rows(sampling.example_readings(df)) == [("ok", "a", 2), ("ok", "a", 3), ("x", "c", 4)]
