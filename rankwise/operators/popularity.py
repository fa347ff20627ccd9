"""Item popularity over ranked lists (#1-#5, #14, #18, #19, #20, #23).

Every function takes a ranked-list DataFrame ``(user_id, rank, <item>, ...)``
and column names, and returns a DataFrame.  All counts are hash aggregates
with map-side partial aggregation, so a very popular item costs one partial
row per task, not one task with all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.columns import by_count_then_item
from rankwise.functions.shared import item_summary

USER = "user_id"


def _keys(item: str | Sequence[str]) -> list[str]:
    return [item] if isinstance(item, str) else list(item)


def top_items(df: DataFrame, item: str | Sequence[str] = "artist", k: int = 20,
              out: str = "participacion") -> DataFrame:
    """#1-#3: the ``k`` items held by most list entries (non-NULL users).

    ``item`` may be a list (e.g. ``["track", "artist"]``) to keep equal titles
    of different artists apart.  Plans as partial/final aggregate +
    ``TakeOrderedAndProject``: each task keeps its own top ``k``.
    """
    keys = _keys(item)
    if len(keys) == 1 and (summary := item_summary(df, keys[0])) is not None:
        return (summary.select(keys[0], F.col("_users").alias(out))
                       .orderBy(*by_count_then_item(out, *keys)).limit(k))
    return (df.groupBy(*keys).agg(F.count(USER).alias(out))
              .orderBy(*by_count_then_item(out, *keys)).limit(k))


def rank_holders(df: DataFrame, item: str = "artist", rank: int = 1,
                 out: str = "users") -> DataFrame:
    """#4: users per item at one list position; the ``rank`` filter is pushed
    into the Parquet scan when ``rank`` is an integer column."""
    if rank == 1 and (summary := item_summary(df, item)) is not None:
        return (summary.filter("_first_rows > 0").select(item, F.col("_first_users").alias(out))
                       .orderBy(*by_count_then_item(out, item)))
    return (df.filter(F.col("rank") == rank).groupBy(item).agg(F.count(USER).alias(out))
              .orderBy(*by_count_then_item(out, item)))


def mode_item(df: DataFrame, item: str = "artist", rank: int = 1) -> DataFrame:
    """#4 (console): the most frequent item at ``rank`` and its frequency,
    ties to the smallest item."""
    return (rank_holders(df, item, rank, out="frecuencia").limit(1)
            .select(F.col(item).alias("moda"), "frecuencia"))


def mention_counts(df: DataFrame, item: str = "artist", out: str = "menciones") -> DataFrame:
    """List rows per item (``count(*)``, so NULL items form one group), in no
    particular order - the input of statistics, which need no sort."""
    if (summary := item_summary(df, item)) is not None:
        return summary.select(item, F.col("_rows").alias(out))
    return df.groupBy(item).agg(F.count(F.lit(1)).alias(out))


def mentions(df: DataFrame, item: str = "artist", out: str = "menciones") -> DataFrame:
    """#5: list rows per item, most mentioned first."""
    return mention_counts(df, item, out).orderBy(*by_count_then_item(out, item))


def avg_position(df: DataFrame, item: str = "artist", min_mentions: int | None = None,
                 out: str = "posicion_media") -> DataFrame:
    """#14: mean list position per item, highest (worst) first."""
    if (summary := item_summary(df, item)) is not None:
        agg = summary.select(item, F.col("_rank_mean").alias(out), F.col("_rows").alias("_n"))
    else:
        agg = df.groupBy(item).agg(F.avg("rank").alias(out), F.count(F.lit(1)).alias("_n"))
    if min_mentions is not None:
        agg = agg.filter(F.col("_n") >= min_mentions)
    return agg.drop("_n").orderBy(*by_count_then_item(out, item))


def heavy_user_items(tracks: DataFrame, item: str = "artist", min_items: int = 40,
                     counted: str = "track", weight: str | None = None,
                     out: str = "total_reproducciones") -> DataFrame:
    """#18: per item, list rows of users holding more than ``min_items``
    non-NULL ``counted`` entries.

    The rows are first reduced to one row per (user, item) - list rows,
    non-NULL ``counted`` entries and (optionally) the summed ``weight`` - by
    a partial aggregate.  The heavy users are a second aggregate of that
    table, and a semi join keeps their rows: both sides read the same
    exchange, and the join can be split on a hot user.  Rows without a user
    match no heavy user, as in the reference's join, and go first.
    ``weight="playcount"`` sums plays instead of counting rows.
    """
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_key = (tracks.filter(F.col(USER).isNotNull()).groupBy(USER, item)
               .agg(measure.alias("_m"), F.count(counted).alias("_c")))
    heavy = per_key.groupBy(USER).agg(F.sum("_c").alias("_n")).filter(F.col("_n") > min_items).select(USER)
    kept = per_key.join(heavy, USER, "left_semi")
    return (kept.groupBy(item).agg(F.sum("_m").cast("bigint").alias(out))
                .orderBy(*by_count_then_item(out, item)))


def _stacked(tracks: DataFrame, artists: DataFrame, item: str, track: str | None = None) -> DataFrame:
    """Both kinds of list rows in one table.  ``_of`` keeps the two NULL items
    apart (NULL keys never match in the reference's full join, so each side
    has a NULL row of its own)."""
    def part(df: DataFrame, kind: int, user, name) -> DataFrame:
        of = F.when(F.col(item).isNull(), F.lit(kind))
        return df.select(F.col(item), of.alias("_of"), F.lit(kind).alias("_k"), user.alias("_u"), name.alias("_t"))

    no_user, no_track = (F.lit(None).cast(df.schema[c].dataType) if c else F.lit(None).cast("string")
                         for df, c in ((artists, USER), (tracks, track)))
    return part(tracks, 1, no_user, F.col(track) if track else no_track).unionByName(
        part(artists, 2, F.col(USER), no_track))


def cross_popularity(tracks: DataFrame, artists: DataFrame, item: str = "artist") -> DataFrame:
    """#19: list rows per artist in the track lists vs in the artist lists:
    the stacked rows are counted once, by kind (no join)."""
    both = item_summary(tracks, item), item_summary(artists, item)
    if None not in both:
        kinds = [s.select(item, F.when(F.col(item).isNull(), F.lit(k)).alias("_of"), F.lit(k).alias("_k"), "_rows")
                 for k, s in enumerate(both, 1)]
        count = [F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("_rows"))), F.lit(0)) for k in (1, 2)]
        per_item = kinds[0].unionByName(kinds[1]).groupBy(item, "_of").agg(
            count[0].alias("tracks_count"), count[1].alias("artists_count"))
    else:
        per_item = _stacked(tracks, artists, item).groupBy(item, "_of").agg(
            F.count_if(F.col("_k") == 1).alias("tracks_count"), F.count_if(F.col("_k") == 2).alias("artists_count"))
    res = per_item.select(item, "tracks_count", "artists_count",
                          (F.col("tracks_count") - F.col("artists_count")).alias("diferencia"))
    return res.orderBy(*by_count_then_item("diferencia", item))


def item_diversity(artists: DataFrame, tracks: DataFrame, item: str = "artist",
                   track: str = "track") -> DataFrame:
    """#20: distinct users per artist (artist lists) and distinct tracks per
    artist (track lists).  The stacked rows are made distinct, which spreads a
    hot artist by value, and then counted by kind (no join, no Expand)."""
    each = _stacked(tracks, artists, item, track).distinct()
    res = each.groupBy(item, "_of").agg(F.count("_u").alias("usuarios_distintos"),
                                        F.count("_t").alias("canciones_distintas"))
    return (res.select(item, "usuarios_distintos", "canciones_distintas")
            .orderBy(*by_count_then_item("usuarios_distintos", item)))


def low_coverage(df: DataFrame, item: str = "artist", threshold: int = 5,
                 out: str = "menciones") -> DataFrame:
    """#23: items with fewer than ``threshold`` list rows."""
    return mentions(df, item, out).filter(F.col(out) < threshold)


def low_coverage_count(df: DataFrame, item: str = "artist", threshold: int = 5) -> DataFrame:
    """#23 (console): how many items are under the threshold (one row)."""
    return low_coverage(df, item, threshold).agg(F.count(F.lit(1)).alias("total"))
