"""Keys that depend on values only, so a retried task gives the same ones again."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_number(*cols: Column | str) -> Column:
    """A non-negative 60-bit number from the text of the columns."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def surrogate_id(col: Column | str) -> Column:
    return stable_number(col)


def unit_key(*cols: Column | str) -> Column:
    """A UUID-shaped text key built from the columns."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in cuts])


def split_label(shares: dict[str, float], *cols: Column | str) -> Column:
    """Assign each row to a named share (for example train 0.6, val 0.2, test 0.2) by its key."""
    draw = F.pmod(stable_number(*cols), F.lit(10_000))
    label, edge = None, 0.0
    for name, share in shares.items():
        edge += share
        test = draw < round(edge * 10_000)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(list(shares)[-1])


def snake_columns(df: DataFrame) -> DataFrame:
    """Column names with '-' and blanks as '_' and all other punctuation removed."""
    return df.toDF(*[re.sub(r"[^0-9A-Za-z_]", "", re.sub(r"[-\s]", "_", c)) for c in df.columns])


def underscore_blanks(col: Column | str) -> Column:
    return F.regexp_replace(col, " ", "_")
