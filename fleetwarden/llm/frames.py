"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that the contracts name, as a character set and as a regular expression.
BLANKS = " \t\n\u000b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def body(column: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def digest(column: str | Column, seed: int = 0) -> Column:
    """64 bits of a value; another seed gives independent 64 bits."""
    return F.xxhash64(F.lit(seed), F.col(column) if isinstance(column, str) else column)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the quicker function."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def row_struct(df: DataFrame, name: str = "_row") -> Column:
    """All columns of df in one, so that helper columns can't clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def with_outputs(df: DataFrame, row: str, **outputs: Column) -> DataFrame:
    """The row's own columns, then the outputs; an input column with an output's name gives way."""
    own = [F.col(row)[c].alias(c) for c in df.schema[row].dataType.names if c not in outputs]
    return df.select(*own, *[v.alias(k) for k, v in outputs.items()])


def row_key(*columns: str | Column) -> list[Column]:
    """128 bits of some columns, never null: k1 and k2."""
    return [F.xxhash64(F.lit(seed), *columns).alias(f"k{seed}") for seed in (1, 2)]


def repeated(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows (_row) as often as decided says, from rows (_row, k1, k2) and decided (k1, k2, n, copies).

    n is how many rows share the key; of several, any one stands for all. Rows of their own, the usual case, pass
    through one join; only the others are grouped.
    """
    decided = decided.where("copies > 0")
    single = rows.join(decided.where("n = 1"), ["k1", "k2"]).select("_row", "copies")
    several = (
        rows.join(decided.where("n > 1"), ["k1", "k2"])
        .groupBy("k1", "k2")
        .agg(F.first("_row").alias("_row"), F.first("copies").alias("copies"))
        .select("_row", "copies")
    )
    return single.unionByName(several).select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))


def unpacked_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that row_struct packed."""
    return df.select(*[F.col("_row")[c].alias(c) for c in columns])


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Python tasks started inside get Arrow batches of at most this size; the session's own setting returns after."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, own)
