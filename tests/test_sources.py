"""Ingest edge cases, result contract, sinks, preview, streaming ingest."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rankwise.functions.contracts import CONTRACTS, RESULT_SOURCES, check_contract, conform, schema_of
from rankwise.plans.export import export_all
from rankwise.plans.registry import ANALYSES
from rankwise.sources.ingest import ARTISTS, USERS, normalize, read_raw_csv, rejected_cells
from rankwise.sources.sinks import (list_results, preview, preview_query, preview_shape, read_result_jdbc,
                                    write_result_jdbc, write_result_parquet)
from rankwise.streaming.ingest_stream import ingest_stream

MALFORMED = '''user_id,rank,artist_name,playcount,extra
u1,x,"C ""q""",5,z
u1,2,"",12.5,z
u2,10,B, 7 ,z
u3,3,D,,z
'''


def test_malformed_cells_become_null_and_are_counted(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(MALFORMED)
    raw = read_raw_csv(spark, str(p))
    got = [tuple(r) for r in normalize(raw, ARTISTS).orderBy("user_id", "playcount").collect()]
    assert got == [("u1", 2, None, None), ("u1", None, 'C "q"', 5), ("u2", 10, "B", 7),
                   ("u3", 3, "D", None)]
    rej = {r["column"]: r["rejected"] for r in rejected_cells(raw, ARTISTS).collect()}
    assert rej == {"rank": 1, "playcount": 1}


def test_numeric_rank_filter_is_pushed_to_parquet(golden):
    plan = golden.artists.filter(F.col("rank") <= 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(rank), LessThanOrEqual(rank,3)]" in plan


def test_users_keep_extra_columns(spark, raw_dir):
    users = normalize(read_raw_csv(spark, os.path.join(raw_dir, "users.csv")), USERS)
    assert users.columns == ["user_id", "country", "total_scrobbles", "age"]


def test_contract_covers_all_result_tables():
    assert len(CONTRACTS) == 24 and set(CONTRACTS) == set(RESULT_SOURCES)
    assert all(q in ANALYSES for q in RESULT_SOURCES.values())


def test_conform_casts_to_contract(golden):
    df = conform(ANALYSES["q13_overlap"](golden), "result_13_overlap")
    assert df.schema.simpleString() == schema_of("result_13_overlap").simpleString()
    r = df.first()
    assert (r.solapamientos, r.total_usuarios, r.proporcion) == (4, 7, Decimal("57.1429"))


def test_wide_contract_keeps_names_and_widens_counts(golden):
    df = conform(ANALYSES["q01_top_artists"](golden), "result_1_top_artists", wide=True)
    assert df.dtypes == [("artist", "string"), ("participacion", "bigint")]


def test_check_contract_reports_double_null_key(golden):
    rep = check_contract(ANALYSES["q19_cross_popularity"](golden), "result_19_cross_popularity").first()
    assert rep["rows"] == 12 and rep["null_keys"] == 2 and rep["duplicate_keys"] == 0


def test_export_parquet_list_and_preview(spark, golden, tmp_path):
    base = str(tmp_path / "results")
    done = export_all(golden, lambda df, t: write_result_parquet(df, base, t))
    assert sorted(done) == sorted(CONTRACTS)
    assert list_results(spark, base) == sorted(CONTRACTS)
    pv = preview(spark, "result_1_top_artists", base, n=3)
    assert [tuple(r) for r in pv.collect()] == [("A", 5), ("B", 3), ("C", 3)]
    assert preview_shape(pv) == (3, 2)
    with pytest.raises(ValueError):
        preview(spark, "result_1_top_artists; DROP TABLE x", base)


def test_jdbc_round_trip_embedded_derby(spark, golden):
    url = "jdbc:derby:memory:rankwise;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_result_jdbc(ANALYSES["q05_stats"](golden), "result_5_stats", url, props)
    write_result_jdbc(ANALYSES["q05_stats"](golden), "result_5_stats", url, props)   # truncate path
    back = read_result_jdbc(spark, "result_5_stats", url, props)
    r = back.first()
    assert back.count() == 1
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["decimal(12,4)"] * 3
    assert (r[0], r[1], r[2]) == (Decimal("1.8000"), Decimal("1.0000"), Decimal("1.3984"))


def test_stream_ingest_is_incremental(spark, tmp_path):
    raw, out, ck = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ck")
    raw.mkdir()
    (raw / "a.csv").write_text("user_id,rank,artist_name,playcount\nu1,1,A,3\nu1,2,B,x\n")
    header = ["user_id", "rank", "artist_name", "playcount"]
    ingest_stream(spark, str(raw), out, "artists", header, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    (raw / "b.csv").write_text("user_id,rank,artist_name,playcount\nu2,1,C,4\n")
    ingest_stream(spark, str(raw), out, "artists", header, ck).awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [("u1", 1, "A", 3), ("u1", 2, "B", None), ("u2", 1, "C", 4)]


def test_stream_refuses_another_column_order(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("rank,user_id,artist_name,playcount\n1,u1,A,3\n")
    query = ingest_stream(spark, str(raw), str(tmp_path / "out"), "artists", None, str(tmp_path / "ck"))
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    assert not list((tmp_path / "out").glob("part-*"))


def test_ingest_counts_rejections_in_its_only_scan(spark, tmp_path):
    from rankwise.sources.ingest import ingest_table

    (tmp_path / "bad.csv").write_text(MALFORMED)
    report = ingest_table(spark, str(tmp_path / "bad.csv"), str(tmp_path / "out"), ARTISTS)
    assert report == [("artists", "rank", 1), ("artists", "playcount", 1)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


BROKEN_CSV = ('user_id,rank,artist_name,playcount\nu1,1,A,3\nu1,2\nu2,1,B,4,more,cells\n'
              'u3,1,"one ""name"" over\ntwo lines",5\nu4,1,,6\n')


@pytest.mark.parametrize("drop", [False, True])
def test_records_with_too_few_or_too_many_cells(spark, tmp_path, drop):
    from rankwise.sources.ingest import BROKEN, ingest_table

    (tmp_path / "bad.csv").write_text(BROKEN_CSV)
    out, aside = str(tmp_path / "out"), str(tmp_path / "aside")
    report = ingest_table(spark, str(tmp_path / "bad.csv"), out, ARTISTS, multi_line=True, drop_broken=drop, quarantine=aside)
    assert report == [("artists", "rank", 0), ("artists", "playcount", 0), ("artists", BROKEN, 2)]
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    whole = [("u1", 1, "A", 3), ("u3", 1, 'one "name" over\ntwo lines', 5), ("u4", 1, None, 6)]
    assert got == sorted(whole + ([] if drop else [("u1", 2, None, None), ("u2", 1, "B", 4)]))
    assert sorted(r.record for r in spark.read.parquet(aside).collect()) == ["u1,2", "u2,1,B,4,more,cells"]


def test_quoted_line_breaks_of_split_files_are_broken_records(spark, tmp_path):
    from rankwise.sources.ingest import ingest

    for name in ("user_top_artists.csv", "user_top_tracks.csv", "user_top_albums.csv", "users.csv"):
        (tmp_path / name).write_text({"user_top_artists.csv": BROKEN_CSV, "users.csv": "user_id,country,total_scrobbles\nu1,ES,1\n"}.get(
            name, f"user_id,rank,{name[9:14]}_name,artist_name,playcount\nu1,1,x,A,1\n"))
    report = {(r.table, r.column): r.rejected for r in ingest(spark, str(tmp_path), str(tmp_path / "out")).collect()}
    # the two short and long records, and both pieces of the record over two lines
    assert report["artists", "_broken_record"] == 4 and ("users", "_broken_record") not in report
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine_artists")).count() == 4
    assert not (tmp_path / "out" / "quarantine_users").exists()


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_a_failed_jdbc_write_leaves_the_old_rows(spark):
    """An in-memory Derby that only this process sees; no server."""
    url = "jdbc:derby:memory:atomic;create=true"
    stored = lambda: sorted(tuple(r) for r in read_result_jdbc(spark, "result_1_top_artists", url, DERBY).collect())
    old = spark.createDataFrame([("A", 3), ("B", 2)], "artist string, participacion long")
    write_result_jdbc(old, "result_1_top_artists", url, DERBY, keys=True)
    assert stored() == [("A", 3), ("B", 2)]
    # a task fails half way
    failing = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("artist"), F.when(
        F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("participacion"))
    with pytest.raises(Exception, match="lost"):
        write_result_jdbc(failing, "result_1_top_artists", url, DERBY)
    assert stored() == [("A", 3), ("B", 2)]
    # the database refuses the rows (a repeated key)
    with pytest.raises(Exception, match="(?i)duplicate key"):
        write_result_jdbc(old.unionAll(old), "result_1_top_artists", url, DERBY)
    assert stored() == [("A", 3), ("B", 2)]
    # the same job again, with rows that fit
    write_result_jdbc(old.filter("artist = 'B'"), "result_1_top_artists", url, DERBY)
    assert stored() == [("B", 2)]
    assert list_results(spark, jdbc_url=url, properties=DERBY) == ["result_1_top_artists"]


def test_jdbc_preview_asks_the_database_for_n_rows(spark):
    url = "jdbc:derby:memory:pushed;create=true"
    rows = spark.createDataFrame([(f"a{i:03d}", i) for i in range(300)], "artist string, participacion long")
    write_result_jdbc(rows, "result_1_top_artists", url, DERBY)
    query = preview_query(spark, "result_1_top_artists", 5, url, DERBY)
    assert query.endswith("FETCH FIRST 5 ROWS ONLY") and "ORDER BY CASE WHEN" in query
    shown = preview(spark, "result_1_top_artists", n=5, jdbc_url=url, properties=DERBY)
    assert query in shown._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in shown.collect()] == [f"a{i:03d}" for i in range(5)]
    assert preview(spark, "result_1_top_artists", n=400, jdbc_url=url, properties=DERBY).count() == 300


def test_wide_results_beyond_int_and_decimal(spark, tmp_path):
    base = (tmp_path / "results").as_uri()          # a URI, not a path
    big = spark.createDataFrame([("A", 3_000_000_000), ("B", 1)], "artist string, participacion long")
    write_result_parquet(big, base, "result_1_top_artists", wide=True)
    mean = spark.createDataFrame([(4e8, 1e9, 0.5)], "media double, mediana double, desviacion_estandar double")
    write_result_parquet(mean, base, "result_5_stats", wide=True)
    assert list_results(spark, base) == ["result_1_top_artists", "result_5_stats"]
    assert [tuple(r) for r in preview(spark, "result_1_top_artists", base).collect()] == [("A", 3_000_000_000), ("B", 1)]
    assert preview(spark, "result_5_stats", base).first()["mediana"] == Decimal("1000000000.0000")


def test_viewer_and_keys_over_jdbc(spark, golden):
    """An in-memory Derby that only this process sees; no server."""
    url = "jdbc:derby:memory:viewer;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = ANALYSES["q04_top1_artist"](golden).filter("artist is not null")
    for _ in range(2):      # created with its key, then truncated
        write_result_jdbc(rows, "result_4_top1_artist", url, props, keys=True)
    assert list_results(spark, jdbc_url=url, properties=props) == ["result_4_top1_artist"]
    assert preview(spark, "result_4_top1_artist", n=2, jdbc_url=url, properties=props).count() == 2
    again = rows.unionAll(rows)
    with pytest.raises(Exception, match="(?i)duplicate key"):
        write_result_jdbc(again, "result_4_top1_artist", url, props, keys=True)


def test_export_reports_and_leaves_no_intermediates(spark, golden, tmp_path):
    from rankwise.functions.materialize import materialize, workspace
    from rankwise.sources.sinks import read_result

    base = str(tmp_path / "results")
    with workspace(spark, str(tmp_path / "work")):
        materialize(golden.users, "users")
        assert os.listdir(tmp_path / "work")
    assert not os.path.exists(tmp_path / "work")
    done = export_all(golden, lambda df, t: write_result_parquet(df, base, t),
                      ["result_22_extreme_users", "result_19_cross_popularity"], read_back=lambda t: read_result(spark, t, base))
    assert done["result_19_cross_popularity"]["null_keys"] == 2 and done["result_22_extreme_users"]["rows"] == 1


def test_full_run_counts_each_list_once_per_item(spark, raw_dir, tmp_path):
    """24 equal results from fewer reads of the ranked lists."""
    from rankwise.functions.contracts import RESULT_SOURCES
    from rankwise.functions.materialize import workspace
    from rankwise.functions.shared import sharing
    from rankwise.plans.domain import list_views
    from rankwise.sources.ingest import ingest
    from rankwise.sources.tables import load_ranked

    out = str(tmp_path / "processed")
    ingest(spark, raw_dir, out)
    views = list_views(load_ranked(spark, out))
    reads = {}

    def lists_read(df):
        return {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()} & {"artists", "tracks", "albums"}

    alone = {}
    for table, name in RESULT_SOURCES.items():
        df = ANALYSES[name](views)
        alone[table] = sorted(map(str, df.collect()))
        reads[table] = lists_read(df)
    together, shared = {}, {}

    def sink(df, table):
        together[table] = sorted(map(str, df.collect()))
        shared[table] = lists_read(df)

    export_all(views, sink)
    assert together == alone and len(together) == 24
    # the summaries themselves: artists by artist, tracks by track and by artist, albums by album
    assert sum(map(len, shared.values())) + 4 <= sum(map(len, reads.values())) - 6
    with workspace(spark), sharing():
        assert ANALYSES["q05_mentions"](views).inputFiles() == ANALYSES["q14_avg_position"](views).inputFiles()


def test_cli_ingest_then_export_meets_contract(spark, raw_dir, tmp_path):
    from rankwise.__main__ import main

    out, res = str(tmp_path / "processed"), str(tmp_path / "results")
    assert main(["ingest", raw_dir, out]) == 0
    assert main(["export", out, res]) == 0
    for table in list_results(spark, res):
        df = spark.read.parquet(os.path.join(res, table))
        assert df.schema.simpleString() == schema_of(table).simpleString(), table
        rep = check_contract(df, table).first()
        assert rep["duplicate_keys"] == 0 and rep["too_long"] == 0, table
