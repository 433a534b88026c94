import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.functions.keys import snake_columns
from fleetwarden.operators.quality import table_ready
from fleetwarden.plans.routes import simulated_position
from fleetwarden.schemas import PLATFORMS, PLATFORMS_UNDERWAY
from fleetwarden.sources import readers, writers

TARGET = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


def test_rescue_of_wrong_types_and_extra_columns(spark, tmp_path):
    good, texts, extra = (str(tmp_path / n) for n in ("good", "texts", "extra"))
    spark.createDataFrame([(1, 1.5)], TARGET).write.parquet(good)
    spark.createDataFrame([(2, "2.5"), (3, "bad"), (4, None)], "id bigint, v string").write.parquet(texts)
    spark.createDataFrame([(5, "x")], "id bigint, note string").write.parquet(extra)
    got = readers.read_rescued(spark, [good, texts, extra], TARGET)
    assert rows(got) == [
        (1, 1.5, None),
        (2, 2.5, None),
        (3, None, '{"v":"bad"}'),
        (4, None, None),
        (5, None, '{"note":"x"}'),
    ]


def test_csv_with_a_quoted_comma(spark, tmp_path):
    (tmp_path / "p.csv").write_text('designator,home_location,lat,long\n"Ship, the first",Port,1.5,2\nother,Port,,3\n')
    got = rows(readers.read_csv(spark, str(tmp_path / "p.csv"), PLATFORMS))
    assert got == [("Ship, the first", "Port", 1.5, 2.0), ("other", "Port", None, 3.0)]


def test_simulated_position_replaces_the_home_position(spark):
    df = spark.createDataFrame([("a", "h", 1.0, 2.0, True, 3.0, 4.0, 5.0, None)], PLATFORMS_UNDERWAY)
    assert rows(simulated_position(df).select("designator", "lat", "long")) == [("a", 3.0, 4.0)]


def test_json(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id": 1, "v": 2.5}\n{"id": 2}\n')
    assert rows(readers.read_json(spark, str(tmp_path / "s.json"), TARGET)) == [(1, 2.5), (2, None)]


def test_file_counts_and_time_order(spark, tmp_path):
    df = spark.range(1000).select((F.lit(1_000_000) - F.col("id") * 1000).alias("timestamp"))
    plain, ordered, daily = (str(tmp_path / n) for n in ("plain", "ordered", "daily"))
    files = lambda d: [f for f in os.listdir(d) if f.startswith("part-")]
    writers.overwrite_folder(df, plain, 3)
    assert len(files(plain)) == 3
    writers.overwrite_time_ordered(df, ordered, 4)
    spans = sorted(
        (r[1], r[2]) for r in spark.read.parquet(ordered).groupBy(F.input_file_name()).agg(
            F.min("timestamp"), F.max("timestamp")).collect()
    )
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    writers.overwrite_by_day(df, daily)
    assert spark.read.parquet(daily).count() == 1000 and any(f.startswith("day=") for f in os.listdir(daily))


def test_time_order_of_many_rows_comes_from_small_sorts(spark, tmp_path, monkeypatch):
    """Rows of a file are sorted in slices; nulls come first, a repeated time lies in one file, and no row is lost."""
    import pyarrow.parquet as pq

    at = F.when(F.col("id") % 500 == 0, None).when(F.col("id") % 5 == 0, 4242).otherwise((F.col("id") * 7919) % 10_007)
    df = spark.range(20_000).select(at.alias("timestamp"), F.col("id").cast("string").alias("unit")).repartition(6)
    sorted_rows, sort = [], type(df).sortWithinPartitions

    def counted(frame, *columns):
        sorted_rows.append(max(r[1] for r in frame.groupBy(F.spark_partition_id()).count().collect()))
        return sort(frame, *columns)

    monkeypatch.setattr(writers, "SLICE_ROWS", 500, raising=False)
    monkeypatch.setattr(type(df), "sortWithinPartitions", counted)
    folder = str(tmp_path / "ordered")
    writers.overwrite_time_ordered(df, folder, 4)
    # A fifth of the rows hold one time, which is one slice.
    assert sorted_rows[0] < 4_900
    held = []
    for name in sorted(f for f in os.listdir(folder) if f.startswith("part-")):
        held.append([-1 if t is None else t for t in pq.read_table(f"{folder}/{name}")["timestamp"].to_pylist()])
    assert len(held) == 4 and all(part == sorted(part) for part in held)
    held.sort()
    assert all(one[-1] < two[0] for one, two in zip(held, held[1:]))
    assert rows(spark.read.parquet(folder)) == rows(df)


def test_feature_table_is_switched_and_rejects_a_broken_key(spark, tmp_path):
    folder, name, keys = str(tmp_path / "f"), "fleet_features", ["turbine_id", "h"]
    good = spark.createDataFrame([("u", 1), ("u", 2)], "turbine_id string, h int")
    first = writers.write_feature_table(good, name, keys, folder)
    assert first.count() == 2
    for bad in (good.unionByName(good), spark.createDataFrame([("u", None)], good.schema)):
        with pytest.raises(ValueError):
            writers.write_feature_table(bad, name, keys, folder)
    assert spark.table(name).count() == 2
    more = good.unionByName(spark.createDataFrame([("v", 1)], good.schema))
    assert writers.write_feature_table(more, name, keys, folder).count() == spark.table(name).count() == 3
    assert rows(first) == [("u", 1), ("u", 2)]  # a reader of the version before still has its files
    broken = more.withColumn("h", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        writers.write_feature_table(broken, name, keys, folder)
    assert spark.table(name).count() == 3
    wider = writers.write_feature_table(more.withColumn("x", F.lit(1.5)), name, keys, folder)
    assert wider.columns == ["turbine_id", "h", "x"] and spark.table(name).agg(F.sum("x")).first()[0] == 4.5
    spark.sql(f"drop table {name}")


def test_tables(spark, tmp_path):
    location = str(tmp_path / "t")
    spark.range(3).write.option("path", location).saveAsTable("fleet_t")
    writers.overwrite_table(spark.range(2).selectExpr("id", "'a' as x"), "fleet_t")
    assert spark.table("fleet_t").columns == ["id", "x"] and table_ready(spark, "fleet_t")
    spark.sql("drop table fleet_t")


def test_names_and_ranges(spark):
    df = spark.createDataFrame([(1,)], ["a-b (c) d"])
    assert snake_columns(df).columns == ["a_b_c_d"]


def test_bucketed_tables_join_and_group_without_an_exchange(spark, sf, monkeypatch):
    import uuid

    from pyspark.sql import functions as F

    from fleetwarden.sources import writers

    name = f"t_{uuid.uuid4().hex}"
    facts = spark.range(2000).select((F.col("id") % 97).alias("unit"), F.col("id").alias("v"))
    dims = spark.range(97).select(F.col("id").alias("unit"), (F.col("id") * 2).alias("w"))
    left = writers.overwrite_bucketed(facts, f"{name}_a", ["unit"], 4)
    right = writers.overwrite_bucketed(dims, f"{name}_b", ["unit"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.join(right, "unit").groupBy("unit").agg(F.sum("v").alias("v"), F.max("w").alias("w"))
        got = {r["unit"]: (r["v"], r["w"]) for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("a", "b"):
            spark.sql(f"DROP TABLE {name}_{t}")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert got == {u: (sum(range(u, 2000, 97)), 2 * u) for u in range(97)}
