"""Distribution statistics (#5 stats, #6, #7, #8, #22).

Scalars that the reference fetched to the driver (``first()``/``count()``)
are computed here as one-row aggregates inside the plan; where a scalar is
needed by a later step it is joined as a one-row side (a size bound of one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwise.functions.columns import median, percent, quantile
from rankwise.functions.materialize import materialize
from rankwise.operators.popularity import mention_counts

USER = "user_id"


def distribution_stats(counts: DataFrame, col: str = "menciones", exact: bool = True) -> DataFrame:
    """#5 stats: mean, median and sample standard deviation of ``col`` in one
    aggregate (the reference ran two jobs)."""
    return counts.agg(
        F.avg(col).alias("media"),
        median(col, exact).alias("mediana"),
        F.stddev_samp(col).alias("desviacion_estandar"))


# ---------------------------------------------------------------- long tail

def mention_histogram(df: DataFrame, item: str = "artist") -> DataFrame:
    """Items per mention count: ``(menciones, items)``.

    The long-tail curve only depends on this table.  It has at most
    sqrt(2 * rows) rows (distinct positive counts summing to the row count),
    so the ordered window over it runs on a bounded input, where the
    reference's window ran over every item in a single partition.
    """
    return (mention_counts(df, item).groupBy("menciones")
            .agg(F.count(F.lit(1)).alias("items")))


def long_tail_curve(df: DataFrame, item: str = "artist") -> DataFrame:
    """Cumulative mentions by mention value, highest first.

    ``menciones_acumuladas`` is the reference's default window frame (RANGE:
    tied items share one cumulative value).
    """
    h = mention_histogram(df, item)
    desc = Window.orderBy(F.col("menciones").desc())
    upto = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(1))
    return (h.withColumn("menciones_acumuladas", F.sum(F.col("menciones") * F.col("items")).over(upto))
             .withColumn("_total", F.sum(F.col("menciones") * F.col("items")).over(whole))
             .withColumn("porc_acumulado", F.col("menciones_acumuladas") / F.col("_total"))
             .select("menciones", "items", "menciones_acumuladas", "porc_acumulado"))


def _count_below(cum_before, m, n, total, share, inclusive_after: bool):
    """Number of items j in 1..n of one tie group (each with ``m`` mentions,
    ``cum_before`` mentions before the group) meeting

    * ``inclusive_after``: (cum_before + j*m) / total <= share   (ROWS "within")
    * otherwise:          (cum_before + (j-1)*m) / total < share (first item reaching)

    The predicate is monotone in j, so the count is found by bisection on
    the exact double predicate: 63 halvings cover any BIGINT group, and the
    answer equals a per-item scan.
    """
    def pred(j):
        if inclusive_after:
            return ((cum_before + j * m) / total) <= F.lit(share)
        return ((cum_before + (j - 1) * m) / total) < F.lit(share)

    def halve(state, _):
        low, high = state["low"], state["high"]          # pred(low) holds (or low = 0), pred(high + 1) does not
        middle = F.floor((low + high + 1) / 2).cast("bigint")
        ok = pred(middle)
        return F.when(low >= high, state).otherwise(F.struct(
            F.when(ok, middle).otherwise(low).alias("low"),
            F.when(ok, high).otherwise(middle - 1).alias("high")))

    start = F.struct(F.lit(0).cast("bigint").alias("low"), n.cast("bigint").alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(63)), start, halve)["low"]


def long_tail(df: DataFrame, item: str = "artist", share: float = 0.8, mode: str = "within",
              names: tuple[str, str, str] = ("artistas_para_80", "total_artistas", "porcentaje")
              ) -> DataFrame:
    """#6: how many items lie within the first ``share`` of all mentions.

    ``mode``:
    * ``within`` (reference): items whose cumulative share, with tied items
      sharing one cumulative value, is <= share; the crossing tie group is
      left out whole;
    * ``within_rows``: the same per item (ties broken arbitrarily);
    * ``reach``: items needed until the cumulative share first reaches
      ``share`` (the crossing item included).
    """
    h = mention_histogram(df, item)
    desc = Window.orderBy(F.col("menciones").desc())
    before = desc.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    mass = F.col("menciones") * F.col("items")
    g = (h.withColumn("_before", F.coalesce(F.sum(mass).over(before), F.lit(0)))
          .withColumn("_total", F.sum(mass).over(whole)))
    cum_before, m, n, total = F.col("_before"), F.col("menciones"), F.col("items"), F.col("_total")
    if mode == "within":
        inside = F.when(((cum_before + m * n) / total) <= F.lit(share), n).otherwise(0)
    elif mode == "within_rows":
        inside = _count_below(cum_before, m, n, total, share, inclusive_after=True)
    elif mode == "reach":
        inside = _count_below(cum_before, m, n, total, share, inclusive_after=False)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    within, total_items, pct = names
    res = g.agg(F.sum(inside).cast("bigint").alias(within),
                F.sum("items").cast("bigint").alias(total_items))
    return res.withColumn(pct, percent(F.col(within), F.col(total_items)))


# ------------------------------------------------------------ items per user

def items_per_user(df: DataFrame, out: str = "num_artistas") -> DataFrame:
    """#7: list rows per user."""
    return df.groupBy(USER).agg(F.count(F.lit(1)).alias(out))


LIST_KINDS = (("num_artistas", "artistas"), ("num_canciones", "tracks"), ("num_albums", "albums"))


def list_lengths(lists: dict[str, DataFrame]) -> DataFrame:
    """Per user, list rows of each kind (``{"num_artistas": artists, ...}``):
    the lists are stacked and counted in one aggregate (one shuffle, partial
    counts), not one aggregate and one join per kind."""
    stacked = None
    for col, df in lists.items():
        part = df.select(USER, F.lit(col).alias("_k"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(USER).agg(*[F.count_if(F.col("_k") == c).alias(c) for c in lists])


def list_length_stats(lengths: DataFrame, exact: bool = True) -> DataFrame:
    """#7 stats from per-user list lengths: mean and median per kind over the
    users that have a list of that kind (a 0 length is not a list)."""
    present = lengths.select(*[F.nullif(F.col(c), F.lit(0)).alias(c) for c, _ in LIST_KINDS])
    aggs = []
    for col, name in LIST_KINDS:
        aggs += [F.avg(col).alias(f"media_{name}"), median(col, exact).alias(f"mediana_{name}")]
    return present.agg(*aggs)


def unique_counts(artists: DataFrame, tracks: DataFrame, albums: DataFrame,
                  approx: bool = False) -> DataFrame:
    """#8: distinct artists, tracks and albums (NULL not counted)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    a = artists.agg(fn("artist").alias("artistas_unicos"))
    t = tracks.agg(fn("track").alias("canciones_unicas"))
    b = albums.agg(fn("album").alias("albums_unicos"))
    return a.crossJoin(t).crossJoin(b)


# ------------------------------------------------------------------ extremes

def exact_quantiles(df: DataFrame, col: str, shares: Sequence[float]) -> DataFrame:
    """One row ``q0, q1, ...``: the discrete quantiles of ``col`` (DOUBLE, NULL without values).

    No task holds all values: the value counts (a partial aggregate) are
    range-partitioned by value and written once; the totals per slice (one
    row each) say which slice holds a quantile, and only that slice is
    summed up in order.
    """
    counts = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    slices = materialize(counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()), "quantile-slices")
    totals = slices.groupBy("_p").agg(F.sum("_n").alias("_in"))
    upto = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(1))
    # one row per slice: the windows here are bounded by the partition count
    placed = totals.withColumn("_to", F.sum("_in").over(upto)).withColumn("_all", F.sum("_in").over(whole))
    wanted = placed.select("_p", (F.col("_to") - F.col("_in")).alias("_from"), "_to", "_all", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("_all"))).alias("k"))
        for i, p in enumerate(shares)])).alias("_q")).filter("_q.k > _from and _q.k <= _to")
    inside = Window.partitionBy("_p", "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most one row per share: a bound that does not depend on the data
    found = (slices.join(F.broadcast(wanted.select("_p", "_from", F.col("_q.i").alias("_i"), F.col("_q.k").alias("_k"))), "_p")
             .withColumn("_cum", F.col("_from") + F.sum("_n").over(inside)).filter(F.col("_cum") >= F.col("_k")))
    return found.agg(*[F.min(F.when(F.col("_i") == i, F.col("_v"))).cast("double").alias(f"q{i}")
                       for i in range(len(shares))])


def extreme_users(users: DataFrame, col: str = "total_scrobbles", low: float = 0.01,
                  high: float = 0.99, exact: bool = True) -> DataFrame:
    """#22: the ``low``/``high`` percentiles of ``col`` and the number of rows
    at or beyond either (inclusive; NULL is never an outlier).

    The percentile row is broadcast into the counting scan: a size bound of
    one row, whatever the table size.  ``exact=False`` takes the mergeable
    sketch of the reference instead of the exact quantiles.
    """
    if exact:
        bounds = exact_quantiles(users, col, (low, high)).select(
            F.col("q0").alias("percentil_1"), F.col("q1").alias("percentil_99"))
    else:
        bounds = users.agg(quantile(col, low, False).alias("percentil_1"),
                           quantile(col, high, False).alias("percentil_99"))
    x = F.col(col)
    lo, hi = F.col("percentil_1"), F.col("percentil_99")
    # the bounds ride along the counting scan (constant per row), so the
    # percentile aggregate runs once; a global aggregate still returns its
    # one row (NULL bounds, 0 rows) on an empty table
    flagged = users.select(col).crossJoin(F.broadcast(bounds))
    return flagged.agg(F.max(lo).alias("percentil_1"), F.max(hi).alias("percentil_99"),
                       F.count_if((x <= lo) | (x >= hi)).alias("total_atipicos"))
