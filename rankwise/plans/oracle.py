"""Plain-SQL statements of every registered analysis, for DuckDB.

They are written the naive way on purpose (per-item windows, self-joins,
subqueries): the Spark plans are rewritten for scale, and these statements
check that the rewrite computes the same thing.  The view prefix is the
derivation of ``rankwise.plans.domain`` (FIXTURES.md section 2).
"""

from __future__ import annotations

VIEWS = """WITH base AS (SELECT o_custkey AS user_id, p_partkey, p_brand,
                   p_brand || ' ' || p_type AS album, l_quantity AS q
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                          JOIN part   ON p_partkey  = l_partkey),
artists AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id
                     ORDER BY sum(q) DESC, p_brand) AS BIGINT) AS rank,
                   p_brand AS artist, CAST(sum(q) AS BIGINT) AS playcount
            FROM base GROUP BY user_id, p_brand),
tracks  AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id
                     ORDER BY sum(q) DESC, p_partkey) AS BIGINT) AS rank,
                   p_partkey AS track, p_brand AS artist, CAST(sum(q) AS BIGINT) AS playcount
            FROM base GROUP BY user_id, p_partkey, p_brand),
albums  AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id
                     ORDER BY sum(q) DESC, album) AS BIGINT) AS rank,
                   album, p_brand AS artist, CAST(sum(q) AS BIGINT) AS playcount
            FROM base GROUP BY user_id, album, p_brand),
ev      AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase'
                     AND ts >= TIMESTAMP '2024-01-25') AS n
            FROM events GROUP BY user_id),
users   AS (SELECT c_custkey AS user_id,
                   CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END AS country,
                   ev.n AS total_scrobbles
            FROM customer JOIN nation ON c_nationkey = n_nationkey
                          LEFT JOIN ev ON ev.user_id = c_custkey)"""

ART_M = ", m AS (SELECT artist, count(*) AS menciones FROM artists GROUP BY artist)"
TRK_M = ", m AS (SELECT track AS artist, count(*) AS menciones FROM tracks GROUP BY track)"


def _top(item: str, table: str) -> str:
    return (f" SELECT {item}, count(user_id) AS participacion FROM {table} GROUP BY {item}"
            f" ORDER BY participacion DESC, {item} ASC NULLS LAST LIMIT 20")


def _long_tail(m: str, within: str, total: str, cond: str, frame: str) -> str:
    return (m + f", c AS (SELECT menciones, sum(menciones) OVER (ORDER BY menciones DESC{frame}) AS cum,"
            " sum(menciones) OVER () AS total FROM m)"
            f" SELECT CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS {within},"
            f" CAST(count(*) AS BIGINT) AS {total},"
            f" round(count(*) FILTER (WHERE {cond}) / count(*) * 100, 4) AS porcentaje FROM c")


ROWS = ", artist ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _stability(table: str) -> str:
    return (f", r1 AS (SELECT user_id, artist AS a1 FROM {table} WHERE rank = 1),"
            f" r2 AS (SELECT user_id, artist AS a2 FROM {table} WHERE rank = 2)"
            " SELECT count(*) AS total FROM r1 JOIN r2 USING (user_id) WHERE a1 = a2")


def _concentrated(n: int) -> str:
    return (f", u AS (SELECT user_id, count(DISTINCT artist) AS d FROM tracks WHERE rank <= {n}"
            " GROUP BY user_id) SELECT count(*) FILTER (WHERE d = 1) AS total FROM u")


def _itemsets(table: str, item: str, size: int, k: int) -> str:
    """Top itemsets by plain self-joins of the baskets; rows without a user are one basket."""
    names = [f"item_{i + 1}" for i in range(size)]
    joins = "".join(f" JOIN b x{i} ON x{i}.user_id IS NOT DISTINCT FROM x0.user_id AND x{i - 1}.item < x{i}.item" for i in range(1, size))
    return (f", b AS (SELECT DISTINCT user_id, {item} AS item FROM {table} WHERE {item} IS NOT NULL) SELECT "
            + ", ".join(f"x{i}.item AS {n}" for i, n in enumerate(names)) + f", count(*) AS cnt FROM b x0{joins}"
            + f" GROUP BY ALL ORDER BY cnt DESC, {', '.join(names)} LIMIT {k}")


# lists whose user is NULL where the customer's balance is negative
UNNAMED = (", named AS (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE user_id END AS user_id, rank, track, artist"
           " FROM tracks JOIN customer ON c_custkey = user_id)")

_HEAD3 = (", l AS (SELECT user_id, list(artist ORDER BY rank) FILTER (WHERE artist IS NOT NULL)"
          " AS lista FROM artists WHERE rank <= 3 GROUP BY user_id)")

BODIES: dict[str, str] = {
    "q01_top_artists": _top("artist", "artists"),
    "q02_top_tracks": _top("track", "tracks"),
    "q03_top_albums": _top("album", "albums"),
    "q04_top1_artist": " SELECT artist, count(user_id) AS users FROM artists WHERE rank = 1 GROUP BY artist",
    "q04_mode": (" SELECT artist AS moda, count(user_id) AS frecuencia FROM artists WHERE rank = 1"
                 " GROUP BY artist ORDER BY frecuencia DESC, artist ASC NULLS LAST LIMIT 1"),
    "q05_mentions": " SELECT artist, count(*) AS menciones FROM artists GROUP BY artist",
    "q05_stats": ART_M + (" SELECT round(avg(menciones), 4) AS media,"
                          " round(CAST(quantile_disc(menciones, 0.5) AS DOUBLE), 4) AS mediana,"
                          " round(stddev_samp(menciones), 4) AS desviacion_estandar FROM m"),
    "q06_long_tail": _long_tail(ART_M, "artistas_para_80", "total_artistas", "cum / total <= 0.8", ""),
    "q06_long_tail_tracks": _long_tail(TRK_M, "canciones_para_80", "total_canciones",
                                       "cum / total <= 0.8", ""),
    "q06_long_tail_rows": _long_tail(ART_M, "artistas_para_80", "total_artistas",
                                     "cum / total <= 0.8", ROWS),
    "q06_long_tail_reach": _long_tail(ART_M, "artistas_para_80", "total_artistas",
                                      "(cum - menciones) / total < 0.8", ROWS),
    "q06_long_tail_reach_tracks": _long_tail(TRK_M, "canciones_para_80", "total_canciones",
                                             "(cum - menciones) / total < 0.8", ROWS),
    "q06_curve": ART_M + (", h AS (SELECT menciones, count(*) AS items FROM m GROUP BY menciones)"
                          " SELECT menciones, items, CAST(sum(menciones * items) OVER (ORDER BY menciones DESC)"
                          " AS BIGINT) AS menciones_acumuladas,"
                          " round(sum(menciones * items) OVER (ORDER BY menciones DESC)"
                          " / sum(menciones * items) OVER (), 4) AS porc_acumulado FROM h"),
    "q07_user_artists": " SELECT user_id, count(*) AS num_artistas FROM artists GROUP BY user_id",
    "q07_user_tracks": " SELECT user_id, count(*) AS num_canciones FROM tracks GROUP BY user_id",
    "q07_user_albums": " SELECT user_id, count(*) AS num_albums FROM albums GROUP BY user_id",
    "q07_stats": (", a AS (SELECT user_id, count(*) AS n FROM artists GROUP BY user_id),"
                  " t AS (SELECT user_id, count(*) AS n FROM tracks GROUP BY user_id),"
                  " b AS (SELECT user_id, count(*) AS n FROM albums GROUP BY user_id)"
                  " SELECT (SELECT round(avg(n), 4) FROM a) AS media_artistas,"
                  " (SELECT round(CAST(quantile_disc(n, 0.5) AS DOUBLE), 4) FROM a) AS mediana_artistas,"
                  " (SELECT round(avg(n), 4) FROM t) AS media_tracks,"
                  " (SELECT round(CAST(quantile_disc(n, 0.5) AS DOUBLE), 4) FROM t) AS mediana_tracks,"
                  " (SELECT round(avg(n), 4) FROM b) AS media_albums,"
                  " (SELECT round(CAST(quantile_disc(n, 0.5) AS DOUBLE), 4) FROM b) AS mediana_albums"),
    "q08_unique_counts": (" SELECT (SELECT count(DISTINCT artist) FROM artists) AS artistas_unicos,"
                          " (SELECT count(DISTINCT track) FROM tracks) AS canciones_unicas,"
                          " (SELECT count(DISTINCT album) FROM albums) AS albums_unicos"),
    # the estimates from sketches lie within their stated error of these counts
    "q08_unique_sketch": (" SELECT (SELECT count(DISTINCT artist) FROM artists) AS artistas_unicos,"
                          " (SELECT count(DISTINCT track) FROM tracks) AS canciones_unicas,"
                          " (SELECT count(DISTINCT album) FROM albums) AS albums_unicos,"
                          " true AS artistas_cerca, true AS canciones_cerca, true AS albums_cerca"),
    "q09_top3_duplicates": _HEAD3 + (" SELECT array_to_string(lista, ',') AS top3_lista,"
                                     " count(*) AS cantidad FROM l GROUP BY lista HAVING count(*) >= 2"),
    "q09_dup_count": _HEAD3 + (", g AS (SELECT lista, count(*) AS c FROM l GROUP BY lista)"
                               " SELECT count(*) FILTER (WHERE c >= 2) AS total FROM g"),
    "q10_concentrated_users": _concentrated(5),
    "q10_concentrated_top2": _concentrated(2),
    "q11_artist_pairs": _itemsets("artists", "artist", 2, 50),
    "q11_album_pairs": _itemsets("albums", "album", 2, 50),
    "q11_track_pairs": _itemsets("tracks", "track", 2, 50),
    "q11_null_users": UNNAMED + _itemsets("named", "track", 2, 50),
    "q12_artist_triples": _itemsets("artists", "artist", 3, 20),
    "q12_album_triples": _itemsets("albums", "album", 3, 20),
    "q12_null_users": UNNAMED + _itemsets("named", "artist", 3, 20),
    "q13_overlap": (", ta AS (SELECT user_id, artist AS a FROM artists WHERE rank = 1),"
                    " tt AS (SELECT user_id, artist AS t FROM tracks WHERE rank = 1),"
                    " s AS (SELECT (SELECT count(*) FROM ta JOIN tt USING (user_id) WHERE a = t) AS o,"
                    " (SELECT count(*) FROM ta) AS n)"
                    " SELECT o AS solapamientos, n AS total_usuarios, round(o / n * 100, 4) AS proporcion FROM s"),
    "q14_tracks": " SELECT track, round(avg(rank), 4) AS posicion_media FROM tracks GROUP BY track",
    "q14_avg_position": " SELECT artist, round(avg(rank), 4) AS posicion_media FROM artists GROUP BY artist",
    "q15_top1_in_global5": ART_M + (
        ", top AS (SELECT artist FROM m ORDER BY menciones DESC, artist ASC NULLS LAST LIMIT 5),"
        " s AS (SELECT count(*) AS n, count(*) FILTER (WHERE artist IN (SELECT artist FROM top)) AS h"
        " FROM artists WHERE rank = 1)"
        " SELECT n AS total_usuarios, h AS usuarios_en_top5, round(h / n * 100, 4) AS proporcion FROM s"),
    "q16_position_stability": _stability("artists"),
    "q16_tracks": _stability("tracks"),
    "q16_null_users": UNNAMED + _stability("named"),
    "q18_null_users": UNNAMED + (
        ", h AS (SELECT user_id FROM named GROUP BY user_id HAVING count(track) > 40)"
        " SELECT artist, count(*) AS total_reproducciones FROM named JOIN h USING (user_id) GROUP BY artist"),
    "q18_heavy_listeners": (", h AS (SELECT user_id FROM tracks GROUP BY user_id HAVING count(track) > 40)"
                            " SELECT artist, count(*) AS total_reproducciones FROM tracks"
                            " WHERE user_id IN (SELECT user_id FROM h) GROUP BY artist"),
    "q19_cross_popularity": (
        ", t AS (SELECT artist, count(*) AS tracks_count FROM tracks GROUP BY artist),"
        " a AS (SELECT artist, count(*) AS artists_count FROM artists GROUP BY artist)"
        " SELECT coalesce(t.artist, a.artist) AS artist, coalesce(tracks_count, 0) AS tracks_count,"
        " coalesce(artists_count, 0) AS artists_count,"
        " coalesce(tracks_count, 0) - coalesce(artists_count, 0) AS diferencia"
        " FROM t FULL OUTER JOIN a ON t.artist = a.artist"),
    "q20_diverse_artists": (
        ", u AS (SELECT artist, count(DISTINCT user_id) AS usuarios_distintos FROM artists GROUP BY artist),"
        " c AS (SELECT artist, count(DISTINCT track) AS canciones_distintas FROM tracks GROUP BY artist)"
        " SELECT coalesce(u.artist, c.artist) AS artist,"
        " coalesce(usuarios_distintos, 0) AS usuarios_distintos,"
        " coalesce(canciones_distintas, 0) AS canciones_distintas"
        " FROM u FULL OUTER JOIN c ON u.artist = c.artist"),
    "q21_missing_flags": (" SELECT user_id, CAST(country IS NULL AS INTEGER) AS no_country,"
                          " CAST(total_scrobbles IS NULL AS INTEGER) AS no_total_scrobbles,"
                          " CAST(country IS NULL AS INTEGER) + CAST(total_scrobbles IS NULL AS INTEGER)"
                          " AS n_missing FROM users"),
    "q21_missing_data": (" SELECT count(*) FILTER (WHERE country IS NULL OR total_scrobbles IS NULL)"
                         " AS missing_users, count(*) FILTER (WHERE total_scrobbles < 1) AS pocos_items"
                         " FROM users"),
    "q22_extreme_users": (", b AS (SELECT CAST(quantile_disc(total_scrobbles, 0.01) AS DOUBLE) AS p1,"
                          " CAST(quantile_disc(total_scrobbles, 0.99) AS DOUBLE) AS p99 FROM users)"
                          " SELECT round(p1, 4) AS percentil_1, round(p99, 4) AS percentil_99,"
                          " (SELECT count(*) FROM users WHERE total_scrobbles <= p1 OR total_scrobbles >= p99)"
                          " AS total_atipicos FROM b"),
    "i01_artists": (" SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(rank AS INTEGER) AS rank, artist, playcount"
                    " FROM artists"),
    "i02_tracks": (" SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(rank AS INTEGER) AS rank,"
                   " CAST(track AS VARCHAR) AS track, artist, playcount FROM tracks"),
    "i03_albums": (" SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(rank AS INTEGER) AS rank, album, artist,"
                   " playcount FROM albums"),
    "i04_users": " SELECT CAST(user_id AS VARCHAR) AS user_id, country, total_scrobbles FROM users",
    "q23_low_coverage": " SELECT artist, count(*) AS menciones FROM artists GROUP BY artist HAVING count(*) < 5",
    "q23_count": (" SELECT count(*) AS total FROM (SELECT artist FROM artists GROUP BY artist"
                  " HAVING count(*) < 5)"),
    "q23_low_coverage_tracks": (" SELECT track, count(*) AS menciones FROM tracks GROUP BY track"
                                " HAVING count(*) < 20"),
    "q23_count_tracks": (" SELECT count(*) AS total FROM (SELECT track FROM tracks GROUP BY track"
                         " HAVING count(*) < 20)"),
    "v01_preview": (" SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(count(*) AS INTEGER) AS num_canciones"
                    " FROM tracks GROUP BY user_id ORDER BY CAST(user_id AS VARCHAR) NULLS LAST LIMIT 100"),
}


# far fewer distinct values than the sketch keeps: it is exact here
for _name in ("q05_stats", "q07_stats", "q22_extreme_users"):
    BODIES[f"{_name}_sketch"] = BODIES[_name]


def oracle_sql() -> dict[str, str]:
    return {name: VIEWS + body for name, body in BODIES.items()}
