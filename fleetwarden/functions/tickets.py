"""Order numbers and priorities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetwarden.schemas import PRIORITIES


def part_order_number(n: Column) -> Column:
    return F.format_string("PR-%06d", n)


def work_order_number(n: Column) -> Column:
    return F.format_string("AI-WO %03d", n)


def priority(level: Column) -> Column:
    chain = None
    for name, value in PRIORITIES:
        chain = F.when(level == name, value) if chain is None else chain.when(level == name, value)
    return chain
