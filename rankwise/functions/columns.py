"""Small column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_count_then_item(count_col: str, *items: str) -> list[Column]:
    """Measure descending, then the item(s) ascending with NULL last.

    The reference sorts by the measure only, so the cut of a top-k with ties
    is arbitrary there; this order makes every result repeatable.
    """
    return [F.col(count_col).desc_nulls_last(), *[F.col(i).asc_nulls_last() for i in items]]


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as DOUBLE; NULL (not an error) for an empty base."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def median(col: str, exact: bool = True) -> Column:
    """Discrete median (a value that exists in the data).

    ``exact``: ``percentile_disc`` whose buffer is a map value -> count,
    partial per task.  For count distributions (mentions, list lengths) the
    number of distinct values is at most sqrt(2 * rows), so the map stays
    small at any scale.  ``exact=False``: the mergeable quantile sketch the
    reference used (``approx_percentile``).
    """
    return quantile(col, 0.5, exact)


def quantile(col: str, p: float, exact: bool = True) -> Column:
    if exact:
        return F.expr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY `{col}`)").cast("double")
    return F.percentile_approx(F.col(col), F.lit(p)).cast("double")


def round_doubles(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round every DOUBLE column (the result contract keeps 4 decimals)."""
    return df.select(*[
        F.round(F.col(f.name), scale).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])
