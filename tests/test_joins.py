import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetwarden.operators import joins


def test_member_join_matches_array_contains(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b,c"), (3, None), (4, "ok")], "id int, fault string")
    owners = spark.createDataFrame(
        [("p", ["a", "a", "x"]), ("q", ["b,c", "a"]), ("r", []), ("s", None), ("t", [None])],
        "type string, sensors array<string>",
    )
    got = rows(joins.member_join(items, owners, "fault", "sensors").select("id", "type"))
    want = rows(items.join(owners, F.array_contains("sensors", F.col("fault"))).select("id", "type"))
    assert got == want == [(1, "p"), (1, "q"), (2, "q")]


def test_member_join_left_keeps_unmatched(spark):
    items = spark.createDataFrame([(1, "a"), (3, None), (4, "ok")], "id int, fault string")
    owners = spark.createDataFrame([("p", ["a"])], "type string, sensors array<string>")
    got = rows(joins.member_join(items, owners, "fault", "sensors", "left").select("id", "type"))
    assert got == [(1, "p"), (3, None), (4, None)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join_on_a_hot_key(spark, how):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), "id")
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(30)], "k bigint, name string")
    bounded = joins.join_dimension(facts, dim, "k", how, salts=8)
    assert "_salt" in bounded._jdf.queryExecution().optimizedPlan().toString()
    assert rows(bounded) == rows(facts.join(dim, "k", how)) == rows(joins.join_dimension(facts, dim, "k", how))


def test_equal_rows_of_a_hot_key_spread_over_the_salts(spark):
    facts = spark.range(0, 4000, 1, 16).select(F.lit("ok").alias("k"))
    dim = spark.createDataFrame([("ok", 1)], "k string, v int")
    joined = joins.salted_join(facts, dim, ["k"], salts=8)
    assert joined.count() == 4000
    parts = F.pmod(F.xxhash64("k", F.spark_partition_id()), F.lit(8))
    assert facts.select(parts.alias("s")).distinct().count() > 3


def test_join_dimension_rejects_joins_that_do_not_preserve_facts(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        joins.join_dimension(df, df, "k", "right")


def test_pair_grid_has_every_pair_once_without_nested_loops(spark):
    left = spark.createDataFrame([(i,) for i in range(5)], "l int")
    right = spark.createDataFrame([(i,) for i in range(23)], "r int")
    grid = joins.pair_grid(left, right)
    assert rows(grid) == sorted(itertools.product(range(5), range(23)), key=repr)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_excludes_both_ends_and_keeps_overlaps(spark):
    rnd = random.Random(3)
    points = [(f"u{rnd.randrange(4)}", rnd.randrange(500)) for _ in range(300)] + [("u0", 100), ("u0", 200)]
    spans = [(f"u{rnd.randrange(4)}", s, s + rnd.randrange(-3, 90)) for s in range(0, 450, 7)] + [("u0", 100, 200)]
    p = spark.createDataFrame(points, "u string, t bigint")
    i = spark.createDataFrame(spans, "u string, s bigint, e bigint")
    got = joins.interval_join(p, i, ["u"], "t", "s", "e", 25).select("u", "t", "s", "e")
    want = [(u, t, s, e) for u, t in points for v, s, e in spans if u == v and s < t < e]
    assert rows(got) == sorted(want, key=repr)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_intervals_of_any_length_take_few_copies(spark):
    rnd = random.Random(4)
    spans = [("u", s, s + 60 * 4 ** rnd.randrange(0, 9)) for s in range(0, 4_000_000, 40_000)]
    points = [("u", rnd.randrange(8_000_000)) for _ in range(200)]
    i = spark.createDataFrame(spans, "u string, s bigint, e bigint")
    p = spark.createDataFrame(points, "u string, t bigint")
    joined = joins.interval_join(p, i, ["u"], "t", "s", "e", 60)
    want = [(u, t, s, e) for u, t in points for _, s, e in spans if s < t < e]
    assert rows(joined.select("u", "t", "s", "e")) == sorted(want, key=repr)
    step = 60 * F.pow(F.lit(4), F.ceil(F.log2((F.col("e") - F.col("s")) / 60) / 2)).cast("bigint")
    touched = F.floor(F.col("e") / step) - F.floor(F.col("s") / step) + 1
    assert i.select(F.max(touched)).first()[0] <= 3


def test_modulo_assign(spark):
    units = spark.range(10).withColumnRenamed("id", "unit")
    owners = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "name string, no bigint")
    got = dict(rows(joins.modulo_assign(units, F.col("unit"), owners, "no")))
    assert got == {u: "abc"[u % 3] for u in range(10)}


def test_crosstab_equals_the_joined_count(spark):
    a = spark.createDataFrame([("u", "ok"), ("u", "ok"), ("v", "x")], "turbine_id string, abnormal_sensor string")
    b = spark.createDataFrame([("u", "p"), ("u", "q"), ("v", "p"), ("w", "p")], "turbine_id string, prediction string")
    want = a.join(b, "turbine_id").groupBy("abnormal_sensor", "prediction").count()
    assert rows(joins.label_crosstab(a, b, "turbine_id")) == rows(want)
