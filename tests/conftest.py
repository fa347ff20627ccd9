from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from rankwise.session import ensure_checkpoint_dir  # noqa: E402

# The hand-made golden set (FIXTURES.md section 3); "" is an empty field.
ARTISTS_CSV = """user_id,rank,artist_name,playcount
u1,1,A,90
u1,2,B,50
u1,3,C,10
u2,1,A,80
u2,2,B,40
u2,3,C,5
u3,1,B,70
u3,2,A,60
u3,3,C,1
u4,1,A,30
u4,2,A,20
u4,3,D,10
u5,1,"X,Y",9
u5,2,Z,8
u5,10,E,1
u6,1,X,9
u6,2,"Y,Z",8
u7,1,,3
"""

TRACKS_CSV = """user_id,rank,track_name,artist_name,playcount
u1,1,t1,A,20
u1,2,t2,A,10
u2,1,t1,A,9
u2,2,t3,B,8
u3,1,t4,C,7
u4,1,t1,A,6
u4,2,t1,D,5
u5,1,t5,,4
u6,1,t6,X,3
u6,2,,X,2
u8,1,t7,W,1
"""

ALBUMS_CSV = """user_id,rank,album_name,artist_name,playcount
u1,1,l1,A,5
u2,1,l1,A,4
u3,1,l2,B,3
u3,2,l1,C,2
"""

USERS_CSV = """user_id,country,total_scrobbles,age
u1,ES,100,30
u2,ES,50,
u3,,10,22
u4,MX,,41
u5,,,19
u6,AR,0,33
u7,AR,1000,27
"""

RAW = {"user_top_artists.csv": ARTISTS_CSV, "user_top_tracks.csv": TRACKS_CSV,
       "user_top_albums.csv": ALBUMS_CSV, "users.csv": USERS_CSV}


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("rankwise-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    for name, text in RAW.items():
        (d / name).write_text(text)
    return str(d)


@pytest.fixture(scope="session")
def golden(spark, raw_dir, tmp_path_factory):
    """The golden set ingested to typed Parquet, as views."""
    from rankwise.plans.domain import list_views
    from rankwise.sources.ingest import ingest
    from rankwise.sources.tables import load_ranked

    out = str(tmp_path_factory.mktemp("processed"))
    report = ingest(spark, raw_dir, out)
    assert report.filter("rejected > 0").count() == 0
    return list_views(load_ranked(spark, out))


def rows(df, *cols):
    """Rows as tuples (selected columns, in order), sorted with NULL last."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
