"""Named analyses: one callable per result table / query key.

Each entry takes the four ranked views and returns a DataFrame whose
columns follow the result names of the reference (Spanish names kept, as
they are the public schema of the results).  DOUBLE results are rounded to
4 decimals, the precision of the result contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.columns import round_doubles
from rankwise.functions.contracts import conform
from rankwise.functions.materialize import materialize
from rankwise.operators import distribution as D
from rankwise.operators import itemsets as I
from rankwise.operators import lists as L
from rankwise.operators import popularity as P
from rankwise.operators import quality as Q
from rankwise.operators import sketches as S
from rankwise.plans.domain import Views
from rankwise.sources.ingest import ingested
from rankwise.sources.sinks import preview_frame

Analysis = Callable[[Views], DataFrame]

# fixed parameters of the reference analyses
TOP_K = 20
GLOBAL_TOP = 5
HEAD_LIST = 3
CONCENTRATION_HEAD = 5
HEAVY_MIN_TRACKS = 40
LOW_COVERAGE = 5
LONG_TAIL_SHARE = 0.8
PAIRS_K = 50
TRIPLES_K = 20
P_LOW, P_HIGH = 0.01, 0.99
MIN_SCROBBLES = 1
PREVIEW_ROWS = 100


SKETCH_SLICES = 16


def unique_by_sketch(v: Views) -> DataFrame:
    """#8 beside its estimate from stored sketches, one per slice of the users, merged."""
    names = {"artist": "artistas", "track": "canciones", "album": "albums"}
    stored = materialize(S.distinct_sketches(v.item_slices(SKETCH_SLICES), list(names), "slice"), "item-sketches")
    exact = {"artist": "artistas_unicos", "track": "canciones_unicas", "album": "albums_unicos"}
    both = v.unique_items().crossJoin(S.distinct_estimates(stored, names))     # one row each
    near = [(F.abs(F.col(names[c]) - F.col(exact[c])) <= S.ERROR * F.col(exact[c])).alias(f"{names[c]}_cerca") for c in names]
    return both.select(*exact.values(), *near)


ANALYSES: dict[str, Analysis] = {
    "q01_top_artists": lambda v: P.top_items(v.artists, "artist", TOP_K),
    "q02_top_tracks": lambda v: P.top_items(v.track_rows, "track", TOP_K),
    "q03_top_albums": lambda v: P.top_items(v.albums, "album", TOP_K),
    "q04_top1_artist": lambda v: P.rank_holders(v.artists, "artist", 1),
    "q04_mode": lambda v: P.mode_item(v.artists, "artist", 1),
    "q05_mentions": lambda v: P.mentions(v.artists, "artist"),
    "q05_stats": lambda v: D.distribution_stats(P.mention_counts(v.artists, "artist"), "menciones"),
    "q06_long_tail": lambda v: D.long_tail(v.artists, "artist", LONG_TAIL_SHARE, "within"),
    "q06_long_tail_tracks": lambda v: D.long_tail(
        v.track_rows, "track", LONG_TAIL_SHARE, "within",
        names=("canciones_para_80", "total_canciones", "porcentaje")),
    "q06_long_tail_rows": lambda v: D.long_tail(v.artists, "artist", LONG_TAIL_SHARE, "within_rows"),
    "q06_long_tail_reach": lambda v: D.long_tail(v.artists, "artist", LONG_TAIL_SHARE, "reach"),
    "q06_long_tail_reach_tracks": lambda v: D.long_tail(
        v.track_rows, "track", LONG_TAIL_SHARE, "reach",
        names=("canciones_para_80", "total_canciones", "porcentaje")),
    "q06_curve": lambda v: D.long_tail_curve(v.artists, "artist"),
    "q07_user_artists": lambda v: D.items_per_user(v.artists, "num_artistas"),
    "q07_user_tracks": lambda v: D.items_per_user(v.track_rows, "num_canciones"),
    "q07_user_albums": lambda v: D.items_per_user(v.albums, "num_albums"),
    "q07_stats": lambda v: D.list_length_stats(v.list_lengths()),
    "q08_unique_counts": lambda v: v.unique_items(),
    "q08_unique_sketch": unique_by_sketch,
    "q09_top3_duplicates": lambda v: L.duplicate_top_lists(v.artists, "artist", HEAD_LIST),
    "q09_dup_count": lambda v: L.duplicate_list_count(v.artists, "artist", HEAD_LIST),
    "q10_concentrated_users": lambda v: L.concentrated_users(v.track_head(CONCENTRATION_HEAD), CONCENTRATION_HEAD),
    "q10_concentrated_top2": lambda v: L.concentrated_users(v.track_head(2), 2),
    "q11_artist_pairs": lambda v: I.frequent_itemsets(v.artists, "artist", 2, PAIRS_K),
    # far more items than the head of the itemset plan holds
    "q11_album_pairs": lambda v: I.frequent_itemsets(v.albums, "album", 2, PAIRS_K),
    "q11_track_pairs": lambda v: I.frequent_itemsets(v.track_rows, "track", 2, PAIRS_K),
    "q12_artist_triples": lambda v: I.frequent_itemsets(v.artists, "artist", 3, TRIPLES_K),
    "q12_album_triples": lambda v: I.frequent_itemsets(v.albums, "album", 3, TRIPLES_K),
    # rows without a user: one basket
    "q11_null_users": lambda v: I.frequent_itemsets(v.unnamed_users().track_rows, "track", 2, PAIRS_K),
    "q12_null_users": lambda v: I.frequent_itemsets(v.unnamed_users().track_rows, "artist", 3, TRIPLES_K),
    "q13_overlap": lambda v: L.top_overlap(v.artists, v.track_head(1), "artist"),
    "q14_avg_position": lambda v: P.avg_position(v.artists, "artist"),
    # full track ranks (range numbering)
    "q14_tracks": lambda v: P.avg_position(v.tracks, "track"),
    "q15_top1_in_global5": lambda v: L.top1_in_global(v.artists, "artist", GLOBAL_TOP),
    "q16_position_stability": lambda v: L.position_stability(v.artists, "artist", 1, 2),
    "q16_tracks": lambda v: L.position_stability(v.track_head(2), "artist", 1, 2),
    # rows without a user
    "q16_null_users": lambda v: L.position_stability(v.unnamed_users().track_head(2), "artist", 1, 2),
    "q18_null_users": lambda v: P.heavy_user_items(v.unnamed_users().track_rows, "artist", HEAVY_MIN_TRACKS),
    "q18_heavy_listeners": lambda v: P.heavy_user_items(v.track_rows, "artist", HEAVY_MIN_TRACKS),
    "q19_cross_popularity": lambda v: P.cross_popularity(v.track_rows, v.artists, "artist"),
    "q20_diverse_artists": lambda v: P.item_diversity(v.artists, v.track_rows, "artist"),
    "q21_missing_flags": lambda v: Q.missing_flags(v.users),
    "q21_missing_data": lambda v: Q.missing_data(v.users, MIN_SCROBBLES),
    "q22_extreme_users": lambda v: D.extreme_users(v.users, "total_scrobbles", P_LOW, P_HIGH),
    # the reference's percentile mode: a mergeable sketch
    "q05_stats_sketch": lambda v: D.distribution_stats(P.mention_counts(v.artists, "artist"), "menciones", exact=False),
    "q07_stats_sketch": lambda v: D.list_length_stats(v.list_lengths(), exact=False),
    "q22_extreme_users_sketch": lambda v: D.extreme_users(v.users, "total_scrobbles", P_LOW, P_HIGH, exact=False),
    "q23_low_coverage": lambda v: P.low_coverage(v.artists, "artist", LOW_COVERAGE),
    "q23_count": lambda v: P.low_coverage_count(v.artists, "artist", LOW_COVERAGE),
    "q23_low_coverage_tracks": lambda v: P.low_coverage(v.track_rows, "track", 20),
    "q23_count_tracks": lambda v: P.low_coverage_count(v.track_rows, "track", 20),
    # ingest: each list as raw CSV, then typed Parquet
    "i01_artists": lambda v: ingested(v.artists, "artists"),
    "i02_tracks": lambda v: ingested(v.tracks, "tracks"),
    "i03_albums": lambda v: ingested(v.albums, "albums"),
    "i04_users": lambda v: ingested(v.users, "users"),
    # the result viewer: first rows of a stored result, in contract types, by key
    "v01_preview": lambda v: preview_frame(conform(D.items_per_user(v.track_rows, "num_canciones"), "result_7_user_tracks"),
                                           "result_7_user_tracks", PREVIEW_ROWS),
}


def run(name: str, v: Views) -> DataFrame:
    return round_doubles(ANALYSES[name](v))
