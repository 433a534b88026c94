from conftest import rows
from pyspark.sql import Observation

from fleetwarden.operators import quality as q
from fleetwarden.operators.quality import Expectation

RULES = [Expectation("warned", "a > 0"), Expectation("dropped", "b IS NOT NULL AND b > 0", drop=True)]


def frame(spark):
    return spark.createDataFrame([(1, 1), (-1, 2), (None, None), (-5, -5)], "a int, b int")


def test_null_predicate_counts_as_violation_and_drops(spark):
    watch = Observation("watch")
    kept = q.expect(frame(spark), RULES, watch)
    assert rows(kept) == [(-1, 2), (1, 1)]
    assert watch.get["rows"] == 4 and watch.get["warned"] == 3


def test_metrics_rows_for_warn_and_drop(spark):
    assert rows(q.expectation_metrics(frame(spark), RULES)) == [
        ("dropped", "drop", 4, 2),
        ("warned", "warn", 4, 3),
    ]


def test_all_rows_fail_and_empty_input(spark):
    bad = spark.createDataFrame([(1, None)], "a int, b int")
    assert q.expect(bad, RULES).isEmpty()
    empty = bad.limit(0)
    assert rows(q.expectation_metrics(empty, RULES)) == [("dropped", "drop", 0, 0), ("warned", "warn", 0, 0)]


def test_key_rule_reaches_the_scan_below_the_aggregate(spark, sf):
    from fleetwarden.plans import bindings as b

    plan = b.sensor_silver(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_extendedprice)" in plan and "l_returnflag" not in plan


def test_gate(spark):
    def accepted(values):
        return q.acceptance_gate(spark.createDataFrame([(v,) for v in values], "prediction string")).first()["accepted"]

    assert accepted(["a", "b", "c", None, None]) and not accepted(["a", None, None]) and accepted([])


def test_key_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 2)], "k string, v int")
    assert rows(q.key_report(df, ["k", "v"])) == [(3, 1, 1)]


def test_table_ready(spark):
    assert not q.table_ready(spark, "no_such_table")
