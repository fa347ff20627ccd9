"""Every analysis on the hand-made golden set (expected answers: FIXTURES.md §3)."""

from __future__ import annotations

import pytest
from conftest import rows

from rankwise.operators import distribution as D
from rankwise.operators import itemsets as I
from rankwise.operators import lists as L
from rankwise.operators import popularity as P
from rankwise.operators import quality as Q


def _one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0].asDict()


def test_typed_ingest(golden):
    s = dict((f.name, f.dataType.simpleString()) for f in golden.artists.schema.fields)
    assert s == {"user_id": "string", "rank": "int", "artist": "string", "playcount": "bigint"}
    assert "age" in golden.users.columns                      # extra columns kept
    assert dict(golden.users.dtypes)["total_scrobbles"] == "bigint"


def test_01_top_artists(golden):
    got = rows(P.top_items(golden.artists, "artist", 20), "artist", "participacion")
    assert got == sorted([("A", 5), ("B", 3), ("C", 3), ("D", 1), ("E", 1), ("X", 1), ("X,Y", 1),
                          ("Y,Z", 1), ("Z", 1), (None, 1)],
                         key=lambda t: (t[0] is None, t[0] or ""))


def test_01_cut_is_repeatable(golden):
    got = [tuple(r) for r in P.top_items(golden.artists, "artist", 4).collect()]
    assert got == [("A", 5), ("B", 3), ("C", 3), ("D", 1)]    # ties by name, NULL last


def test_02_03_top_tracks_albums(golden):
    t = dict((r[0], r[1]) for r in P.top_items(golden.tracks, "track", 20).collect())
    assert t == {"t1": 4, "t2": 1, "t3": 1, "t4": 1, "t5": 1, "t6": 1, "t7": 1, None: 1}
    a = dict((r[0], r[1]) for r in P.top_items(golden.albums, "album", 20).collect())
    assert a == {"l1": 3, "l2": 1}


def test_02_by_track_and_artist(golden):
    got = rows(P.top_items(golden.tracks, ["track", "artist"], 20), "track", "artist", "participacion")
    assert ("t1", "A", 3) in got and ("t1", "D", 1) in got


def test_04_rank_holders_and_mode(golden):
    got = dict((r[0], r[1]) for r in P.rank_holders(golden.artists, "artist", 1).collect())
    assert got == {"A": 3, "B": 1, "X,Y": 1, "X": 1, None: 1}
    assert _one(P.mode_item(golden.artists, "artist")) == {"moda": "A", "frecuencia": 3}


def test_05_mentions_stats(golden):
    m = P.mentions(golden.artists, "artist")
    assert m.agg({"menciones": "sum"}).first()[0] == 18
    s = _one(D.distribution_stats(m, "menciones"))
    assert s["media"] == pytest.approx(1.8)
    assert s["mediana"] == 1.0
    assert round(s["desviacion_estandar"], 4) == 1.3984
    approx = _one(D.distribution_stats(m, "menciones", exact=False))
    assert approx["mediana"] == 1.0


def test_06_long_tail_modes(golden):
    w = _one(D.long_tail(golden.artists, "artist", 0.8, "within"))
    assert w == {"artistas_para_80": 3, "total_artistas": 10, "porcentaje": 30.0}
    assert _one(D.long_tail(golden.artists, "artist", 0.8, "within_rows"))["artistas_para_80"] == 6
    assert _one(D.long_tail(golden.artists, "artist", 0.8, "reach"))["artistas_para_80"] == 7


def test_06_curve(golden):
    c = rows(D.long_tail_curve(golden.artists, "artist"), "menciones", "items", "menciones_acumuladas")
    assert c == [(1, 7, 18), (3, 2, 11), (5, 1, 5)]


def test_07_items_per_user(golden):
    s = _one(D.list_length_stats(golden.list_lengths()))
    assert round(s["media_artistas"], 4) == 2.5714 and s["mediana_artistas"] == 3.0
    assert round(s["media_tracks"], 4) == 1.5714 and s["mediana_tracks"] == 2.0
    assert round(s["media_albums"], 4) == 1.3333 and s["mediana_albums"] == 1.0
    per = dict((r[0], r[1]) for r in D.items_per_user(golden.artists, "num_artistas").collect())
    assert per["u4"] == 3 and per["u7"] == 1


def test_08_unique_counts(golden):
    assert _one(D.unique_counts(golden.artists, golden.tracks, golden.albums)) == {
        "artistas_unicos": 9, "canciones_unicas": 7, "albums_unicos": 2}
    assert _one(golden.unique_items())["canciones_unicas"] == 7


def test_09_duplicate_lists_group_on_the_list(golden):
    got = rows(L.duplicate_top_lists(golden.artists, "artist", 3), "top3_lista", "cantidad")
    # "X,Y"+"Z" and "X"+"Y,Z" print alike but are different lists
    assert got == [("A,B,C", 2)]
    assert _one(L.duplicate_list_count(golden.artists, "artist", 3)) == {"total": 1}


def test_10_concentrated(golden):
    assert _one(L.concentrated_users(golden.tracks, 5)) == {"total": 4}
    assert _one(L.concentrated_users(golden.tracks, 5, require_full=True)) == {"total": 0}


def test_11_12_itemsets(golden):
    pairs = rows(I.frequent_itemsets(golden.artists, "artist", 2, 50), "item_1", "item_2", "cnt")
    assert sorted(pairs) == sorted([("A", "B", 3), ("A", "C", 3), ("B", "C", 3), ("A", "D", 1),
                                    ("E", "X,Y", 1), ("E", "Z", 1), ("X", "Y,Z", 1), ("X,Y", "Z", 1)])
    triples = rows(I.frequent_itemsets(golden.artists, "artist", 3, 20))
    assert sorted(triples) == [("A", "B", "C", 3), ("E", "X,Y", "Z", 1)]
    top1 = [tuple(r) for r in I.frequent_itemsets(golden.artists, "artist", 2, 1).collect()]
    assert top1 == [("A", "B", 3)]


def test_13_overlap(golden):
    r = _one(L.top_overlap(golden.artists, golden.tracks, "artist"))
    assert (r["solapamientos"], r["total_usuarios"]) == (4, 7)
    assert round(r["proporcion"], 4) == 57.1429


def test_14_avg_position(golden):
    got = dict((r[0], round(r[1], 4)) for r in P.avg_position(golden.artists, "artist").collect())
    assert got == {"E": 10.0, "C": 3.0, "D": 3.0, "Y,Z": 2.0, "Z": 2.0, "B": 1.6667, "A": 1.4,
                   "X": 1.0, "X,Y": 1.0, None: 1.0}
    first = P.avg_position(golden.artists, "artist").first()
    assert first[0] == "E"
    assert P.avg_position(golden.artists, "artist", min_mentions=2).count() == 3


def test_15_top1_in_global(golden):
    r = _one(L.top1_in_global(golden.artists, "artist", 5))
    assert (r["total_usuarios"], r["usuarios_en_top5"]) == (7, 4)
    assert round(r["proporcion"], 4) == 57.1429


def test_16_position_stability(golden):
    assert _one(L.position_stability(golden.artists, "artist", 1, 2)) == {"total": 1}


def test_18_heavy_users(golden):
    got = dict((r[0], r[1]) for r in P.heavy_user_items(golden.tracks, "artist", 1).collect())
    assert got == {"A": 4, "B": 1, "D": 1}
    w = dict((r[0], r[1]) for r in
             P.heavy_user_items(golden.tracks, "artist", 1, weight="playcount").collect())
    assert w == {"A": 20 + 10 + 9 + 6, "B": 8, "D": 5}


def test_19_cross_popularity_keeps_both_null_rows(golden):
    got = rows(P.cross_popularity(golden.tracks, golden.artists, "artist"))
    expected = [("W", 1, 0, 1), ("X", 2, 1, 1), (None, 1, 0, 1), ("D", 1, 1, 0), ("A", 4, 5, -1),
                ("E", 0, 1, -1), ("X,Y", 0, 1, -1), ("Y,Z", 0, 1, -1), ("Z", 0, 1, -1),
                (None, 0, 1, -1), ("B", 1, 3, -2), ("C", 1, 3, -2)]
    assert got == rows_sorted(expected)


def test_20_item_diversity(golden):
    got = rows(P.item_diversity(golden.artists, golden.tracks, "artist"))
    expected = [("A", 4, 2), ("B", 3, 1), ("C", 3, 1), ("D", 1, 1), ("X", 1, 1), ("E", 1, 0),
                ("X,Y", 1, 0), ("Y,Z", 1, 0), ("Z", 1, 0), (None, 1, 0), ("W", 0, 1), (None, 0, 1)]
    assert got == rows_sorted(expected)


def test_21_missing(golden):
    assert _one(Q.missing_data(golden.users, 1)) == {"missing_users": 3, "pocos_items": 1}
    flags = dict((r["user_id"], r["n_missing"]) for r in Q.missing_flags(golden.users).collect())
    assert flags == {"u1": 0, "u2": 0, "u3": 1, "u4": 1, "u5": 2, "u6": 0, "u7": 0}


def test_22_extremes(golden):
    assert _one(D.extreme_users(golden.users, "total_scrobbles")) == {
        "percentil_1": 0.0, "percentil_99": 1000.0, "total_atipicos": 2}
    assert _one(D.extreme_users(golden.users, "total_scrobbles", exact=False))["total_atipicos"] == 2
    nobody = golden.users.filter("false")
    assert _one(D.extreme_users(nobody, "total_scrobbles")) == {
        "percentil_1": None, "percentil_99": None, "total_atipicos": 0}


def test_23_low_coverage(golden):
    assert P.low_coverage(golden.artists, "artist", 5).count() == 9
    assert _one(P.low_coverage_count(golden.artists, "artist", 5)) == {"total": 9}


def rows_sorted(expected):
    return sorted(expected, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
