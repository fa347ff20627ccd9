"""Sub-aggregates that several results of one run need, computed once.

Many results count the same list by the same item: mentions, top lists,
statistics of the mentions, mean positions, holders of the first place.
Inside ``sharing()`` the first of them to ask for the summary of (list, item)
writes it, with every count the others need, and all read that table.
Outside, an operator aggregates only what it returns itself.

Lists are told apart by what Spark says of their plans (``sameSemantics``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize

_RUNS: list[list[tuple[DataFrame, str, DataFrame]]] = []


@contextmanager
def sharing() -> Iterator[None]:
    """Operators called inside share the summaries of their lists."""
    _RUNS.append([])
    try:
        yield
    finally:
        _RUNS.pop()


def _first(what: Column | None = None) -> Column:
    at_first = F.col("rank") == 1
    return F.count_if(at_first if what is None else at_first & what.isNotNull())


def item_summary(df: DataFrame, item: str) -> DataFrame | None:
    """<item>, _rows, _users (rows with a user), _first_rows, _first_users, _rank_mean; None outside a shared run.

    For lists with a ``rank`` only.  A NULL item is a group, as in the operators.
    """
    if not _RUNS or "rank" not in df.columns:
        return None
    for known, by, summary in _RUNS[-1]:
        if by == item and known.sameSemantics(df):
            return summary
    summary = materialize(df.groupBy(item).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("user_id").alias("_users"), _first().alias("_first_rows"),
        _first(F.col("user_id")).alias("_first_users"), F.avg("rank").alias("_rank_mean")), f"summary-{item}")
    _RUNS[-1].append((df, item, summary))
    return summary
