"""Predictions joined with platforms and maintenance actions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.joins import join_dimension
from fleetwarden.operators.quality import expect, not_null
from fleetwarden.operators.ranking import keep_first, latest_per_unit, latest_snapshot


def current_predictions(
    silver: DataFrame, meta: DataFrame, scorer: Column | Callable[[DataFrame], DataFrame], latest_only: bool = False
) -> DataFrame:
    """Statistics with platform columns and a prediction; `scorer` is a column or a frame -> frame step.

    One row per unit and hour (or per unit): grouping already made the statistics unique, so only platform rows
    can repeat a unit. Those are reduced before the join, which leaves the large side without a window and free
    to be split by AQE when one unit owns much of it.
    """
    places = [F.col(c) for c in meta.columns if c != "turbine_id"]
    rows = latest_per_unit(silver) if latest_only else silver
    kept = rows.join(keep_first(meta, ["turbine_id"], places), "turbine_id")
    scored = kept.withColumn("prediction", scorer) if isinstance(scorer, Column) else scorer(kept)
    return expect(scored, not_null("turbine_id", "hourly_timestamp", "prediction"))


def with_maintenance(predictions: DataFrame, actions: DataFrame) -> DataFrame:
    """Left join on prediction = fault; healthy rows keep nulls."""
    renamed = actions.withColumnRenamed("fault", "prediction")
    return join_dimension(predictions, renamed, "prediction", "left")


def status_gold(
    silver: DataFrame,
    meta: DataFrame,
    actions: DataFrame,
    scorer: Column | Callable[[DataFrame], DataFrame],
    latest_only: bool = False,
) -> DataFrame:
    gold = with_maintenance(current_predictions(silver, meta, scorer, latest_only), actions)
    return expect(gold, not_null("turbine_id", "prediction"))


def newest_status(gold: DataFrame) -> DataFrame:
    return latest_snapshot(gold, "hourly_timestamp")


def damaged_flag(df: DataFrame, label: str = "abnormal_sensor") -> DataFrame:
    return df.withColumn("damaged", F.col(label) != "ok")
