"""Expectations: named row rules that are counted, and optionally drop the rows that fail them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    rule: str
    drop: bool = False

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.rule), F.lit(False))


def not_null(*cols: str) -> list[Expectation]:
    return [Expectation(f"{c}_valid", f"{c} IS NOT NULL", drop=True) for c in cols]


def rule_counts(rules: list[Expectation]) -> list[Column]:
    """Rows, rows that a drop rule removes, and violations of each rule."""
    dropped = [~r.holds() for r in rules if r.drop]
    any_drop = reduce(lambda a, b: a | b, dropped) if dropped else F.lit(False)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_drop).alias("dropped"),
        *[F.count_if(~r.holds()).alias(r.name) for r in rules],
    ]


def expect(df: DataFrame, rules: list[Expectation], observation: Observation | str | None = None) -> DataFrame:
    """Rows that pass every drop rule.

    With an observation all rules are counted on the way (batch or stream); without one the filter is a plain
    predicate, which Catalyst may push below aggregates and into the scan.
    """
    if observation is not None:
        df = df.observe(observation, *rule_counts(rules))
    for rule in rules:
        if rule.drop:
            df = df.filter(F.expr(rule.rule))
    return df


def expectation_metrics(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule: action, rows seen, violations; a single aggregation pass."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds()).alias(r.name) for r in rules])
    action = F.when(F.col("rule").isin([r.name for r in rules if r.drop]), "drop").otherwise("warn")
    return counted.unpivot("rows", [r.name for r in rules], "rule", "violations").select(
        "rule", action.alias("action"), "rows", "violations"
    )


def acceptance_gate(df: DataFrame, prediction: str = "prediction", threshold: float = 0.6) -> DataFrame:
    """One row: accepted when nothing failed or the success rate reaches the threshold."""
    total, good = F.col("total"), F.col("succeeded")
    rate = F.when(total > 0, good / total).otherwise(0.0)
    return (
        df.agg(F.count(F.lit(1)).alias("total"), F.count(prediction).alias("succeeded"))
        .withColumn("failed", total - good)
        .withColumn("success_rate", rate)
        .withColumn("accepted", (F.col("failed") == 0) | (F.col("success_rate") >= threshold))
    )


def key_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys, keys that occur more than once, rows with a null in the key."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        )
    )


def table_ready(spark, name: str) -> bool:
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()
