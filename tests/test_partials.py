import datetime as dt
import os

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetwarden.functions import holidays
from fleetwarden.operators import partials
from fleetwarden.operators.quality import Expectation
from fleetwarden.operators.stats import statistic_columns
from fleetwarden.session import staged
from fleetwarden.streaming import hourly, ingest


def test_merged_partials_equal_one_pass(spark):
    rng = np.random.default_rng(2)
    data = [("u" if i % 3 else "v", i % 5, float(1e9 + rng.normal()), float(rng.random()) if i % 4 else None) for i in range(900)]
    data += [("none", 0, 1.0, None)]
    df = spark.createDataFrame(data, "k string, part int, energy double, s double")
    stored = staged(partials.partial_statistics(df, ["k", "part"], ["s"]))
    once = partials.final_statistics(partials.merge_partials(stored, ["k"], "part"), ["k"])
    # In two steps: parts merge to larger parts and these to the whole.
    halves = partials.merge_partials(stored.withColumn("half", F.col("part") % 2), ["k", "half"], "part")
    twice = partials.final_statistics(partials.merge_partials(halves, ["k"], "half"), ["k"])
    want = {r["k"]: r for r in df.groupBy("k").agg(F.avg("energy").alias("e"), F.stddev_pop("s").alias("d"), F.count("s").alias("n")).collect()}
    for found in (once, twice):
        for r in found.collect():
            w = want[r["k"]]
            assert r["avg_energy"] == pytest.approx(w["e"], rel=1e-15)
            if w["n"]:
                assert r["std_s"] == pytest.approx(w["d"], abs=1e-12)
            else:
                assert r["std_s"] is None and r["percentiles_s"] is None
    moments = partials.merge_partials(partials.partial_statistics(df, ["k", "part"], ["energy"]), ["k"], "part")
    deviation = {r["k"]: r["std_energy"] for r in partials.final_statistics(moments, ["k"]).collect()}
    exact = np.array([d[2] for d in data if d[0] == "u"])
    assert deviation["u"] == pytest.approx((exact - exact.mean()).std(), rel=1e-6)  # no cancellation at a mean of 1e9


def test_sketches_keep_their_bound(spark):
    rng = np.random.default_rng(4)
    values = rng.permutation(np.arange(20_000) / 20_000)
    df = spark.createDataFrame([(i % 7, float(v)) for i, v in enumerate(values)], "part int, energy double")
    merged = partials.merge_partials(partials.partial_statistics(df, [F.lit(1).alias("k"), "part"], ["energy"]), ["k"], "part")
    got = partials.final_statistics(merged, ["k"]).first()["percentiles_energy"]
    assert np.abs(np.array(got) - [0.1, 0.3, 0.6, 0.8, 0.95]).max() < 0.03


def test_late_rows_are_kept_counted_and_replayed(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = "turbine_id string, event_time timestamp, energy double"
    drops = [
        [("u", at(5), 1.0), ("u", at(200), 1.0)],
        [("u", at(6), 9.0), ("u", at(150), 4.0), ("u", at(400), 3.0), ("w", None, 7.0)],
        [("u", at(7), 2.0), ("u", at(395), 5.0)],
    ]
    table = hourly.HourlyPartials(spark, str(tmp_path / "t"), ["turbine_id"], "event_time", ["energy"], "60 minutes")
    for number, drop in enumerate(drops):
        table.store(spark.createDataFrame(drop, schema), number)
    want = [(0, 2, 0), (1, 4, 2), (2, 2, 1)]
    assert rows(table.batches().select("batch", "rows", "late")) == want
    assert rows(table.late().select("energy")) == [(2.0,), (7.0,), (9.0,)]
    everything = spark.createDataFrame([r for d in drops for r in d if r[1]], schema)
    aggs = statistic_columns(sensors=["energy"])
    batch = everything.groupBy("turbine_id", F.date_trunc("hour", "event_time").alias("hourly_timestamp")).agg(*aggs)
    columns = ["turbine_id", "hourly_timestamp", F.round("avg_energy", 9), F.round("std_energy", 9), "percentiles_energy"]
    assert rows(table.statistics().select(*columns)) == rows(batch.select(*columns))
    assert rows(table.statistics(with_late=False).select("avg_energy")) == [(1.0,), (1.0,), (4.0,), (4.0,)]
    before = rows(table.statistics().select(*columns))
    table.store(spark.createDataFrame(drops[1], schema), 1)  # again, as after a failure
    assert rows(table.batches().select("batch", "rows", "late")) == want
    assert rows(table.statistics().select(*columns)) == before


def test_newest_time_is_carried_from_batch_to_batch(spark, tmp_path, monkeypatch):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = "turbine_id string, event_time timestamp, energy double"
    table = hourly.HourlyPartials(spark, str(tmp_path / "t"), ["turbine_id"], "event_time", ["energy"], "60 minutes")
    drops = [[], [("u", at(500), 1.0)], [("u", at(450), 1.0)], [("u", None, 1.0)], [], [("u", at(439), 1.0), ("u", at(441), 1.0)]]
    whole = table.batches
    monkeypatch.setattr(table, "batches", lambda: pytest.fail("all batches were read"))
    for number, drop in enumerate(drops):
        table.store(spark.createDataFrame(drop, schema), number)
    monkeypatch.setattr(table, "batches", whole)
    table.store(spark.createDataFrame([("u", at(100), 1.0)], schema), 8)  # numbers 6 and 7 were left out
    assert rows(table.batches().select("batch", "rows", "late", "high")) == [
        (0, 0, 0, None), *[(i, n, late, at(500)) for i, n, late in [(1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 0, 0), (5, 2, 1), (8, 1, 1)]]
    ]


def test_counts_come_from_the_write_over_many_batches(spark, tmp_path, monkeypatch):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    spark.range(0, 2010, 1, 201).selectExpr("id", "id % 10 AS v").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    rules = [Expectation("small", "v < 9", drop=True), Expectation("even", "v % 2 = 0")]
    scans = []
    read = ingest.read_landing
    monkeypatch.setattr(ingest, "read_landing", lambda *a: scans.append(1) or read(*a))
    counts = ingest.ingest_files(spark, landing, table, state, schema, rules, 1)
    assert len(scans) == len([d for d in os.listdir(table) if d.startswith("batch=")]) > 200
    assert counts == {"rows": 2010, "dropped": 201, "small": 201, "even": 1005}
    assert spark.read.parquet(table).count() == 1809


def test_holiday_rules_against_plain_dates(spark):
    def nth(year, month, weekday, n):
        days = [dt.date(year, month, 1) + dt.timedelta(i) for i in range(31)]
        days = [d for d in days if d.month == month and d.weekday() == weekday]
        return days[n - 1] if n > 0 else days[n]

    # Published dates of Easter Sunday.
    easter = {1954: (4, 18), 1981: (4, 19), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25), 2049: (4, 18), 2076: (4, 19)}
    years = spark.createDataFrame([(y,) for y in easter], "y int")
    got = {r["y"]: (r["e"].month, r["e"].day) for r in years.select("y", holidays.easter_sunday(F.col("y")).alias("e")).collect()}
    assert got == easter
    found = {}
    for r in holidays.calendar(spark, 2019, 2028).collect():
        found.setdefault(r["holiday"], []).append((r["day"], r["observed"]))
    assert all(len(v) == 10 for v in found.values()) and len(found) == 11
    for name, args in (("Memorial Day", (5, 0, -1)), ("Thanksgiving", (11, 3, 4)), ("Labor Day", (9, 0, 1))):
        assert sorted(d for d, _ in found[name]) == [nth(y, *args) for y in range(2019, 2029)]
    assert (dt.date(2021, 7, 4), dt.date(2021, 7, 5)) in found["Independence Day"]
    assert (dt.date(2021, 12, 25), dt.date(2021, 12, 24)) in found["Christmas Day"]


def test_rows_keep_their_columns_and_number(spark):
    dates = holidays.calendar(spark, 2024, 2024, (*holidays.UNITED_STATES, holidays.Holiday("Feast", 7, 4)))
    df = spark.createDataFrame([(1, "2024-07-04"), (2, "2024-07-05"), (3, None)], "day int, d string")
    got = rows(holidays.with_holidays(df, F.col("d"), dates))
    assert got == [(1, "2024-07-04", ["Feast", "Independence Day"], True), (2, "2024-07-05", [], False), (3, None, [], False)]


def test_rows_are_near_each_other_before_they_are_reduced(spark):
    df = spark.createDataFrame([("u", 3600, 1.0, 2.0)], "k string, ts bigint, energy double, s double")
    hour = F.floor(F.col("ts") / 3600).alias("hour")
    parts = partials.partial_statistics(df, ["k", hour], ["s"])
    assert parts.columns[:2] == ["k", "hour"] and parts.first()["hour"] == 1
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange hashpartitioning(_near") > plan.index("partial_kll")
