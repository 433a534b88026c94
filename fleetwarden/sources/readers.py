"""Batch readers with explicit schemas, and the rescued-data column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; quoted fields may hold commas."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def sensor_columns(df: DataFrame) -> list[str]:
    """Names that contain 'sensor', the label column among them."""
    return [c for c in df.columns if "sensor" in c]


def rescue(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns plus _rescued_data.

    Values that do not cast to the declared type and columns the schema does not name go into a JSON object;
    _rescued_data is null when there are none.
    """
    present = set(df.columns)
    kept: list[Column] = []
    saved: list[Column] = []
    for field in schema.fields:
        if field.name not in present:
            kept.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif df.schema[field.name].dataType == field.dataType:
            kept.append(F.col(field.name))
        else:
            typed = F.col(field.name).try_cast(field.dataType)
            kept.append(typed.alias(field.name))
            saved.append(F.when(typed.isNull(), F.col(field.name)).alias(field.name))
    saved += [F.col(c) for c in df.columns if c not in schema.names and c != RESCUED]
    if not saved:
        return df.select(*kept, F.lit(None).cast("string").alias(RESCUED))
    packed = F.to_json(F.struct(*saved))
    return df.select(*kept, F.nullif(packed, F.lit("{}")).alias(RESCUED))


def read_rescued(spark: SparkSession, drops: list[str], schema: T.StructType) -> DataFrame:
    """Landing drops, each read with the types its own files carry, brought to one schema."""
    return reduce(DataFrame.unionByName, [rescue(spark.read.parquet(d), schema) for d in drops])
