"""Coercion of model inputs and array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_number(col: Column | str) -> Column:
    """Number or 0.0 for anything missing or unparsable."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def parsed_array(text: Column | str, size: int) -> Column:
    """Text such as '[1.0, 2.0]' as an array of doubles; `size` zeros for null or malformed text."""
    zeros = F.array_repeat(F.lit(0.0), size)
    parsed = F.from_json(text, "array<double>")
    return F.when(parsed.isNull() | F.exists(parsed, lambda x: x.isNull()), zeros).otherwise(parsed)


def clean_request(df: DataFrame, numbers: list[str], arrays: list[str], size: int = 5) -> DataFrame:
    """Scoring inputs without nulls: numbers become 0.0, arrays become zeros."""
    zeros = F.array_repeat(F.lit(0.0), size)
    fixed = {n: clean_number(n) for n in numbers}
    for a in arrays:
        is_text = isinstance(df.schema[a].dataType, T.StringType)
        fixed[a] = parsed_array(a, size) if is_text else F.coalesce(F.col(a), zeros)
    return df.withColumns(fixed)


def spread_array(df: DataFrame, col: str, size: int) -> DataFrame:
    """One array column as `size` numbered columns in its place."""
    out = []
    for c in df.columns:
        if c == col:
            out += [F.get(c, i).alias(f"{c}_{i + 1}") for i in range(size)]
        else:
            out.append(F.col(c))
    return df.select(*out)


def request_json(*cols: str) -> Column:
    """A row as request JSON with ISO timestamps."""
    return F.to_json(F.struct(*cols), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"})
