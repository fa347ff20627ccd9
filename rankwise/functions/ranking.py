"""Position of a row inside its group (``row_number`` per group).

Two strategies give the same numbers (BIGINT):

``window``
    ``row_number() OVER (PARTITION BY g ORDER BY ...)``.  One shuffle on the
    group key; each group is sorted inside one task.  Right when a group is
    bounded, e.g. a user's brands (the brand domain is fixed).

``range``
    For groups that may be huge (one user holding a third of all rows).  The
    rows are range-partitioned on ``(g, order...)`` so a hot group is cut
    into slices, which are written once to the shared checkpoint folder (the
    steps below then see the same slices, even after an executor loss).  A
    row's position is its ``row_number`` inside (slice, group) plus the rows
    its group has in earlier slices; only the last group of a slice can go
    on, so that offset table has at most one row per slice, a bound that does
    not grow with the data.  Everything stays in SQL expressions: no value of
    a row passes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize

_SLICE = "_rw_slice"


def position_within(df: DataFrame, group: str, order: Sequence[Column],
                    out: str = "rank", strategy: str = "window") -> DataFrame:
    """Add ``out`` = 1-based position of each row in its ``group`` by ``order``.

    ``order`` must make a total order inside a group (add a unique key as the
    last sort column) so the numbering is repeatable.
    """
    if strategy == "window":
        w = Window.partitionBy(group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if strategy == "range":
        return _range_position(df, group, list(order), out)
    raise ValueError(f"unknown strategy {strategy!r}")


def _range_position(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    by = [F.col(group).asc_nulls_last(), *order]
    slices = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn(_SLICE, F.spark_partition_id()), "ranked-slices")
    # groups in slice order: names ascending, then the NULL group
    place = F.struct(F.col(group).isNull().alias("n"), F.col(group).alias("g"))
    ends = slices.groupBy(_SLICE).agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    tail = (slices.join(F.broadcast(ends), _SLICE).groupBy(_SLICE, "_first", "_last")
            .agg(F.count_if(F.col(group).eqNullSafe(F.col("_last.g"))).alias("_tail")))
    before = Window.partitionBy("_last").orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per slice
    offsets = (tail.withColumn("_run", F.sum("_tail").over(before))
               .withColumn("_prev", F.lag(F.struct(F.col("_last").alias("last"), F.col("_run").alias("run")))
                           .over(Window.orderBy(_SLICE)))
               .filter(F.col("_prev.last").eqNullSafe(F.col("_first")) & F.col("_prev").isNotNull())
               .select(F.col(_SLICE).alias("_of"), F.col("_first.g").alias("_group"), F.col("_prev.run").alias("_offset")))
    local = F.row_number().over(Window.partitionBy(_SLICE, group).orderBy(*order)).cast("bigint")
    numbered = slices.withColumn(out, local)
    joined = numbered.join(F.broadcast(offsets), (F.col(_SLICE) == F.col("_of"))
                           & F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.withColumn(out, F.col(out) + F.coalesce(F.col("_offset"), F.lit(0))).drop(
        _SLICE, "_of", "_group", "_offset")
