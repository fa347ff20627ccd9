"""Data-quality checks on the user dimension (#21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the fields whose absence the reference reports
REQUIRED = ("country", "total_scrobbles")


def _absent(fields: Sequence[str]) -> dict[str, Column]:
    """One 0/1 flag per field, named after it."""
    return {f"no_{f}": F.col(f).isNull().cast("int") for f in fields}


def missing_flags(users: DataFrame, fields: Sequence[str] = REQUIRED) -> DataFrame:
    """#21: per user, a flag for every missing field and how many are missing."""
    flags = _absent(fields)
    total = sum(flags.values(), F.lit(0))
    return users.select("user_id", *[c.alias(n) for n, c in flags.items()], total.alias("n_missing"))


def missing_data(users: DataFrame, minimum: int = 1, measure: str = "total_scrobbles",
                 fields: Sequence[str] = REQUIRED) -> DataFrame:
    """#21: users with any missing field, and users under ``minimum`` (NULL is
    not under it) - both counts from a single scan."""
    return users.agg(
        F.count_if(sum(_absent(fields).values(), F.lit(0)) > 0).alias("missing_users"),
        F.count_if(F.col(measure) < minimum).alias("pocos_items"))
