"""Prediction columns: the placeholder scorer and trained models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.keys import stable_number

# The placeholder scorer's share of healthy rows and its faults.
HEALTHY_SHARE = 0.9
PLACEHOLDER_FAULTS = ("sensor_F", "sensor_D", "sensor_B")


def placeholder_prediction(
    *key: str | Column, healthy: float = HEALTHY_SHARE, faults: tuple[str, ...] = PLACEHOLDER_FAULTS
) -> Column:
    """'ok' for the healthy share of rows, else one of the faults, drawn from the row's key."""
    draw = stable_number(*key)
    pick = F.pmod(F.shiftright(draw, 20), F.lit(len(faults))) + 1
    choice = F.element_at(F.array(*[F.lit(f) for f in faults]), pick.cast("int"))
    return F.when(F.pmod(draw, F.lit(1000)) < round(healthy * 1000), "ok").otherwise(choice)


def score_with_model(df: DataFrame, model, labels: list[str]) -> DataFrame:
    """Apply a fitted Spark ML pipeline; `prediction` becomes the label text, null where scoring gave none."""
    names = F.array(*[F.lit(x) for x in labels])
    scored = model.transform(df).withColumn("_class", F.col("prediction").cast("int"))
    return scored.withColumn("prediction", F.get(names, F.col("_class"))).select(*df.columns, "prediction")
