"""Result contract (K1, K2): names, order and types of the result tables.

``conform`` casts a result to its contract in Spark (INT, DECIMAL(12,4),
text), so the stored types do not depend on the target database;
``check_contract`` reports key and length violations as a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    sql: str              # VARCHAR(n) | INT | DECIMAL(12,4)
    key: bool = False


# fixed values: result tables and columns of the reference's result schema
CONTRACTS: dict[str, tuple[Col, ...]] = {
    "result_1_top_artists": (Col("artist", "VARCHAR(255)", True), Col("participacion", "INT")),
    "result_2_top_tracks": (Col("track", "VARCHAR(255)", True), Col("participacion", "INT")),
    "result_3_top_albums": (Col("album", "VARCHAR(255)", True), Col("participacion", "INT")),
    "result_4_top1_artist": (Col("artist", "VARCHAR(255)", True), Col("users", "INT")),
    "result_5_mentions_per_artist": (Col("artist", "VARCHAR(255)", True), Col("menciones", "INT")),
    "result_5_stats": (Col("media", "DECIMAL(12,4)"), Col("mediana", "DECIMAL(12,4)"),
                       Col("desviacion_estandar", "DECIMAL(12,4)")),
    "result_6_long_tail": (Col("artistas_para_80", "INT"), Col("total_artistas", "INT"),
                           Col("porcentaje", "DECIMAL(12,4)")),
    "result_7_user_artists": (Col("user_id", "VARCHAR(255)", True), Col("num_artistas", "INT")),
    "result_7_user_tracks": (Col("user_id", "VARCHAR(255)", True), Col("num_canciones", "INT")),
    "result_7_user_albums": (Col("user_id", "VARCHAR(255)", True), Col("num_albums", "INT")),
    "result_7_stats": (Col("media_artistas", "DECIMAL(12,4)"), Col("mediana_artistas", "DECIMAL(12,4)"),
                       Col("media_tracks", "DECIMAL(12,4)"), Col("mediana_tracks", "DECIMAL(12,4)"),
                       Col("media_albums", "DECIMAL(12,4)"), Col("mediana_albums", "DECIMAL(12,4)")),
    "result_8_unique_counts": (Col("artistas_unicos", "INT"), Col("canciones_unicas", "INT"),
                               Col("albums_unicos", "INT")),
    "result_9_top3_duplicates": (Col("top3_lista", "VARCHAR(500)"), Col("cantidad", "INT")),
    "result_10_concentrated_users": (Col("total", "INT"),),
    "result_13_overlap": (Col("solapamientos", "INT"), Col("total_usuarios", "INT"),
                          Col("proporcion", "DECIMAL(12,4)")),
    "result_14_avg_position": (Col("artist", "VARCHAR(255)", True), Col("posicion_media", "DECIMAL(12,4)")),
    "result_15_top1_in_global5": (Col("total_usuarios", "INT"), Col("usuarios_en_top5", "INT"),
                                  Col("proporcion", "DECIMAL(12,4)")),
    "result_16_position_stability": (Col("total", "INT"),),
    "result_18_heavy_listeners": (Col("artist", "VARCHAR(255)", True), Col("total_reproducciones", "INT")),
    "result_19_cross_popularity": (Col("artist", "VARCHAR(255)", True), Col("tracks_count", "INT"),
                                   Col("artists_count", "INT"), Col("diferencia", "INT")),
    "result_20_diverse_artists": (Col("artist", "VARCHAR(255)", True), Col("usuarios_distintos", "INT"),
                                  Col("canciones_distintas", "INT")),
    "result_21_missing_data": (Col("missing_users", "INT"), Col("pocos_items", "INT")),
    "result_22_extreme_users": (Col("percentil_1", "DECIMAL(12,4)"), Col("percentil_99", "DECIMAL(12,4)"),
                                Col("total_atipicos", "INT")),
    "result_23_low_coverage_artists": (Col("artist", "VARCHAR(255)", True), Col("menciones", "INT")),
}

# result table <- registered analysis
RESULT_SOURCES: dict[str, str] = {
    "result_1_top_artists": "q01_top_artists",
    "result_2_top_tracks": "q02_top_tracks",
    "result_3_top_albums": "q03_top_albums",
    "result_4_top1_artist": "q04_top1_artist",
    "result_5_mentions_per_artist": "q05_mentions",
    "result_5_stats": "q05_stats",
    "result_6_long_tail": "q06_long_tail",
    "result_7_user_artists": "q07_user_artists",
    "result_7_user_tracks": "q07_user_tracks",
    "result_7_user_albums": "q07_user_albums",
    "result_7_stats": "q07_stats",
    "result_8_unique_counts": "q08_unique_counts",
    "result_9_top3_duplicates": "q09_top3_duplicates",
    "result_10_concentrated_users": "q10_concentrated_users",
    "result_13_overlap": "q13_overlap",
    "result_14_avg_position": "q14_avg_position",
    "result_15_top1_in_global5": "q15_top1_in_global5",
    "result_16_position_stability": "q16_position_stability",
    "result_18_heavy_listeners": "q18_heavy_listeners",
    "result_19_cross_popularity": "q19_cross_popularity",
    "result_20_diverse_artists": "q20_diverse_artists",
    "result_21_missing_data": "q21_missing_data",
    "result_22_extreme_users": "q22_extreme_users",
    "result_23_low_coverage_artists": "q23_low_coverage",
}


#: types of the wide contract: counts past 2**31, means past 10**8
_WIDE = {"INT": "BIGINT", "DECIMAL(12,4)": "DECIMAL(28,4)"}


def sql_type(sql: str, wide: bool = False) -> str:
    return _WIDE.get(sql.upper(), sql) if wide else sql


def spark_type(sql: str, wide: bool = False) -> T.DataType:
    s = sql_type(sql, wide).upper()
    if s == "INT":
        return T.IntegerType()
    if s == "BIGINT":
        return T.LongType()
    if s.startswith("DECIMAL"):
        p, q = s[s.index("(") + 1:s.index(")")].split(",")
        return T.DecimalType(int(p), int(q))
    if s.startswith("VARCHAR"):
        return T.StringType()
    raise ValueError(sql)


def schema_of(table: str, wide: bool = False) -> T.StructType:
    return T.StructType([T.StructField(c.name, spark_type(c.sql, wide), True) for c in CONTRACTS[table]])


def column_types_ddl(table: str, wide: bool = False) -> str:
    """``createTableColumnTypes`` text for the JDBC sink (first creation)."""
    return ", ".join(f"{c.name} {sql_type(c.sql, wide)}" for c in CONTRACTS[table])


def conform(df: DataFrame, table: str, wide: bool = False) -> DataFrame:
    """Select the contract columns in order and cast them (DECIMAL rounds
    half-up to 4 places in Spark, before any database sees the value).

    The contract's counts are INT and its means DECIMAL(12,4); where a count
    can pass 2**31 or a mean 10**8 a cast would fail (ANSI mode) rather than
    wrap, so ``wide=True`` stores BIGINT and DECIMAL(28,4), with the same
    names and order.
    """
    return df.select(*[F.col(c.name).cast(spark_type(c.sql, wide)).alias(c.name)
                       for c in CONTRACTS[table]])


def check_contract(df: DataFrame, table: str) -> DataFrame:
    """One row: row count, NULL keys, duplicate keys, text over its length."""
    cols = CONTRACTS[table]
    keys = [c.name for c in cols if c.key]
    aggs = [F.count(F.lit(1)).alias("rows")]
    if keys:
        k = F.col(keys[0])
        aggs += [F.count_if(k.isNull()).alias("null_keys"),
                 (F.count(k) - F.count_distinct(k)).alias("duplicate_keys")]
    else:
        aggs += [F.lit(0).cast("bigint").alias("null_keys"), F.lit(0).cast("bigint").alias("duplicate_keys")]
    long_checks = [F.length(F.col(c.name).cast("string")) > int(c.sql[8:-1])
                   for c in cols if c.sql.startswith("VARCHAR")]
    over = F.lit(False)
    for cond in long_checks:
        over = over | F.coalesce(cond, F.lit(False))
    aggs.append(F.count_if(over).alias("too_long"))
    return df.agg(*aggs).select(F.lit(table).alias("table"), "*")
