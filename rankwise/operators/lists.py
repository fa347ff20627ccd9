"""Analyses over the head of each user's list (#9, #10, #13, #15, #16).

Rank filters (``rank == 1``, ``rank <= n``) are plain predicates on an
integer column, so they reach the Parquet scan as pushed filters.  Every
per-user step here touches at most ``n`` rows per user (ranks are positions),
so no per-user group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.columns import percent
from rankwise.functions.shared import item_summary

USER = "user_id"


def head_lists(df: DataFrame, item: str = "artist", n: int = 3) -> DataFrame:
    """Per user, the items at positions 1..n in rank order (NULL items
    skipped, as ``collect_list`` does in the reference).  The list is sorted
    by rank, so it does not depend on row arrival order."""
    entry = F.when(F.col(item).isNotNull(), F.struct(F.col("rank").alias("r"), F.col(item).alias("i")))
    return (df.filter(F.col("rank") <= n).groupBy(USER)
              .agg(F.array_sort(F.collect_list(entry)).alias("_e"))
              .select(USER, F.transform("_e", lambda e: e["i"]).alias("lista")))


def duplicate_top_lists(df: DataFrame, item: str = "artist", n: int = 3, min_users: int = 2,
                        sep: str = ",") -> DataFrame:
    """#9: head lists held by at least ``min_users`` users.

    Grouping is on the list itself (an array), so ``["X,Y","Z"]`` and
    ``["X","Y,Z"]`` stay apart; the joined text is only for display.  A list
    shared by a third of all users is still one partial count per task.
    """
    counted = head_lists(df, item, n).groupBy("lista").agg(F.count(F.lit(1)).alias("cantidad"))
    return (counted.filter(F.col("cantidad") >= min_users)
                   .orderBy(F.col("cantidad").desc(), F.col("lista").asc())
                   .select(F.concat_ws(sep, "lista").alias("top3_lista"), "cantidad"))


def duplicate_list_count(df: DataFrame, item: str = "artist", n: int = 3,
                         min_users: int = 2) -> DataFrame:
    """#9 (console): how many distinct head lists are shared (one row)."""
    counted = head_lists(df, item, n).groupBy("lista").agg(F.count(F.lit(1)).alias("c"))
    return counted.agg(F.count_if(F.col("c") >= min_users).alias("total"))


def concentrated_users(tracks: DataFrame, n: int = 5, distinct: str = "artist",
                       require_full: bool = False) -> DataFrame:
    """#10: users whose top-``n`` entries all share one ``distinct`` value.

    As in the reference, users with fewer than ``n`` entries count too;
    ``require_full=True`` asks for exactly ``n`` entries.  Users whose values
    are all NULL have 0 distinct values and are not counted.
    """
    per_user = (tracks.filter(F.col("rank") <= n).groupBy(USER)
                .agg(F.count_distinct(distinct).alias("_d"), F.count(F.lit(1)).alias("_rows")))
    cond = F.col("_d") == 1
    if require_full:
        cond = cond & (F.col("_rows") == n)
    return per_user.agg(F.count_if(cond).alias("total"))


def top_overlap(artists: DataFrame, tracks: DataFrame, item: str = "artist") -> DataFrame:
    """#13: users whose #1 artist is the artist of their #1 track.

    Base = rank-1 rows of the artist lists, including users with no track
    list.  The reference joins the two rank-1 sides on the user and counts
    rows with equal artists; that count is, per (user, artist), rank-1 artist
    rows times rank-1 track rows (NULL users and artists never match).  So
    both heads are stacked and aggregated once on (user, artist): no join,
    one shuffle with partial aggregation, the same numbers.
    """
    a = artists.filter(F.col("rank") == 1).select(USER, F.col(item).alias("_i"), F.lit(1).alias("_src"))
    t = tracks.filter(F.col("rank") == 1).select(USER, F.col(item).alias("_i"), F.lit(2).alias("_src"))
    per_key = (a.unionByName(t).groupBy(USER, "_i")
               .agg(F.count_if(F.col("_src") == 1).alias("_a"), F.count_if(F.col("_src") == 2).alias("_t")))
    matches = F.when(F.col(USER).isNotNull() & F.col("_i").isNotNull(), F.col("_a") * F.col("_t"))
    res = per_key.agg(F.coalesce(F.sum(matches), F.lit(0)).cast("bigint").alias("solapamientos"),
                      F.coalesce(F.sum("_a"), F.lit(0)).cast("bigint").alias("total_usuarios"))
    return res.withColumn("proporcion", percent(F.col("solapamientos"), F.col("total_usuarios")))


def top1_in_global(artists: DataFrame, item: str = "artist", k: int = 5) -> DataFrame:
    """#15: share of users whose #1 item is among the ``k`` most mentioned.

    One aggregate per item gives both its mentions and its rank-1 rows; the
    ``k`` most mentioned items (a top-k, ``k`` rows) then carry the number of
    users whose #1 they are, so no join is needed (NULL items, which never
    match in the reference's join, are left out); the base is the sum of
    rank-1 rows over all items.
    """
    if (summary := item_summary(artists, item)) is not None:
        per_item = summary.select(item, F.col("_rows").alias("_m"), F.col("_first_rows").alias("_ones"))
    else:
        per_item = artists.groupBy(item).agg(F.count(F.lit(1)).alias("_m"),
                                             F.count_if(F.col("rank") == 1).alias("_ones"))
    top = (per_item.orderBy(F.col("_m").desc(), F.col(item).asc_nulls_last()).limit(k)
           .agg(F.sum(F.when(F.col(item).isNotNull(), F.col("_ones"))).alias("_hit")))
    base = per_item.agg(F.sum("_ones").alias("_all"))
    res = top.crossJoin(base).select(
        F.coalesce(F.col("_all"), F.lit(0)).cast("bigint").alias("total_usuarios"),
        F.coalesce(F.col("_hit"), F.lit(0)).cast("bigint").alias("usuarios_en_top5"))
    return res.withColumn("proporcion", percent(F.col("usuarios_en_top5"), F.col("total_usuarios")))


def position_stability(df: DataFrame, item: str = "artist", first: int = 1,
                       second: int = 2) -> DataFrame:
    """#16: (user, entry at ``first``, entry at ``second``) pairs with the same
    item - the reference's self-join count - as one aggregate on
    (user, item): per key, rows at ``first`` times rows at ``second``.
    NULL users and items match nothing, as in the join.
    No self-join, one shuffle, partial aggregation on a hot user."""
    r = F.col("rank")
    # the range bound first: over a row_number window it becomes a partial
    # group limit before the shuffle
    per_key = (df.filter(r <= max(first, second))
                 .filter(r.isin(first, second) & F.col(item).isNotNull() & F.col(USER).isNotNull())
                 .groupBy(USER, item)
                 .agg(F.count_if(r == first).alias("_a"), F.count_if(r == second).alias("_b")))
    return per_key.agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0)).cast("bigint").alias("total"))
