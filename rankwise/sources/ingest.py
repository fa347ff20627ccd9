"""Raw CSV -> typed Parquet.

The raw files are per-user top lists with a header row.  Columns are picked
by header name (not position) and typed with ``try_cast``: a malformed cell
becomes NULL instead of failing the job, and the write that ingests the file
also counts how many cells were turned into NULL that way, per column.

Differences from a plain ``spark.read.csv(path, header=True)``:
* the escape character is the double quote, so a doubled quote inside a
  quoted field reads as one quote (RFC 4180);
* numbers are typed, so ``rank`` filters compare as numbers and reach the
  Parquet scan as pushed filters;
* records with too few or too many cells are counted by the scan that ingests
  the file and copied, as text, to a quarantine table.  In the typed table
  they stay as far as they can be read, or go (``drop_broken``).

A line break inside quotes belongs to its cell with ``multi_line=True``: the
file is then read by one task, as no other place tells where a record starts.
Without it files are split, and the two pieces of such a record are broken
ones.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rankwise.session import checkpoint_path

#: holds the text of a record that does not have one cell per header
BROKEN = "_broken_record"
#: columns of the rejected-cell report
REPORT = "table string, column string, rejected bigint"


@dataclass(frozen=True)
class ListSpec:
    """How one raw file maps to a typed table: (source header, target name,
    target type) per column; ``keep_rest`` passes other columns as text."""
    name: str
    raw_file: str
    columns: tuple[tuple[str, str, str], ...]
    keep_rest: bool = False


# fixed values: raw file names and header names of the source archive
ARTISTS = ListSpec("artists", "user_top_artists.csv", (
    ("user_id", "user_id", "string"), ("rank", "rank", "int"),
    ("artist_name", "artist", "string"), ("playcount", "playcount", "bigint")))
TRACKS = ListSpec("tracks", "user_top_tracks.csv", (
    ("user_id", "user_id", "string"), ("rank", "rank", "int"),
    ("track_name", "track", "string"), ("artist_name", "artist", "string"),
    ("playcount", "playcount", "bigint")))
ALBUMS = ListSpec("albums", "user_top_albums.csv", (
    ("user_id", "user_id", "string"), ("rank", "rank", "int"),
    ("album_name", "album", "string"), ("artist_name", "artist", "string"),
    ("playcount", "playcount", "bigint")))
USERS = ListSpec("users", "users.csv", (
    ("user_id", "user_id", "string"), ("country", "country", "string"),
    ("total_scrobbles", "total_scrobbles", "bigint")), keep_rest=True)

SPECS = {s.name: s for s in (ARTISTS, TRACKS, ALBUMS, USERS)}


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, broken: bool = False) -> DataFrame:
    """All-text CSV scan with a header row (no schema inference pass).

    With ``broken`` the column ``BROKEN`` holds the text of records that do
    not have one cell per header.
    """
    read = (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE"))
    if not broken:
        return read.csv(path)
    kind = StructType([StructField(c, StringType()) for c in [*read.csv(path).columns, BROKEN]])
    return read.option("columnNameOfCorruptRecord", BROKEN).schema(kind).csv(path)


def _typed(raw: Column, dtype: str) -> Column:
    if dtype == "string":
        return raw
    return F.trim(raw).try_cast(dtype)


def normalize(raw: DataFrame, spec: ListSpec) -> DataFrame:
    """Pick, rename and type the columns of ``spec``."""
    missing = [src for src, _, _ in spec.columns if src not in raw.columns]
    if missing:
        raise ValueError(f"{spec.name}: raw file lacks columns {missing}")
    cols = [_typed(F.col(f"`{src}`"), t).alias(dst) for src, dst, t in spec.columns]
    if spec.keep_rest:
        taken = {src for src, _, _ in spec.columns}
        cols += [F.col(f"`{c}`") for c in raw.columns if c not in taken and c != BROKEN]
    return raw.select(*cols)


def _rejections(spec: ListSpec) -> dict[str, Column]:
    """Per typed column, the number of cells that held text but did not parse."""
    return {dst: F.count_if(F.col(f"`{src}`").isNotNull() & _typed(F.col(f"`{src}`"), t).isNull())
            for src, dst, t in spec.columns if t != "string"}


def rejected_cells(raw: DataFrame, spec: ListSpec) -> DataFrame:
    """The rejections of a raw table as rows (table, column, rejected)."""
    counts = _rejections(spec)
    if not counts:
        return raw.sparkSession.createDataFrame([], REPORT)
    agg = raw.agg(*[c.alias(n) for n, c in counts.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in counts)
    return agg.selectExpr(f"'{spec.name}' AS table", f"stack({len(counts)}, {stack}) AS (column, rejected)")


def read_ranked_csv(spark: SparkSession, path: str, spec: ListSpec | str) -> DataFrame:
    spec = SPECS[spec] if isinstance(spec, str) else spec
    return normalize(read_raw_csv(spark, path), spec)


def write_processed(df: DataFrame, path: str) -> None:
    """S3: Parquet, overwrite."""
    df.write.mode("overwrite").parquet(path)


def ingest_table(spark: SparkSession, raw_path: str, out_path: str, spec: ListSpec, multi_line: bool = False,
                 drop_broken: bool = False, quarantine: str | None = None) -> list[tuple[str, str, int]]:
    """One raw file -> typed Parquet, in a single scan of the raw file.

    The rejected cells and the broken records are counted by the write itself
    (an observation), and returned as (table, column, rejected) rows.  If
    there are broken records, a row with the column ``BROKEN`` has their
    number, and their text goes to the folder ``quarantine``, if given.
    """
    raw = read_raw_csv(spark, raw_path, multi_line, broken=True)
    is_broken = F.col(BROKEN).isNotNull()
    counts = _rejections(spec)
    seen = Observation(f"rejected-{spec.name}")
    watched = raw.observe(seen, F.count_if(is_broken).alias(BROKEN), *[c.alias(n) for n, c in counts.items()])
    rows = normalize(watched.filter(~is_broken) if drop_broken else watched, spec)
    write_processed(rows, out_path)
    found = seen.get
    if quarantine is not None and found[BROKEN]:
        # BROKEN alone would make the scan skip splitting a record into cells
        write_processed(raw.filter(is_broken).select(F.col(BROKEN).alias("record"), F.struct(
            *[F.col(f"`{c}`") for c in raw.columns if c != BROKEN]).alias("cells")), quarantine)
    return [(spec.name, n, found[n]) for n in counts] + ([(spec.name, BROKEN, found[BROKEN])] if found[BROKEN] else [])


def ingest(spark: SparkSession, raw_dir: str, out_dir: str, files: dict[str, str] | None = None,
           multi_line: bool = False, drop_broken: bool = False) -> DataFrame:
    """The four raw files of ``raw_dir`` -> ``out_dir/{artists,...}``.

    ``files`` overrides raw file names per table (the upload and the loader
    of the reference disagree on the users file name).  Returns the report of
    rejected cells and broken records of all four tables; the text of broken
    records is in ``out_dir/quarantine_<table>``.
    """
    files = files or {}
    report = []
    for name, spec in SPECS.items():
        report += ingest_table(spark, os.path.join(raw_dir, files.get(name, spec.raw_file)),
                               os.path.join(out_dir, name), spec, multi_line, drop_broken,
                               os.path.join(out_dir, f"quarantine_{name}"))
    return spark.createDataFrame(report, REPORT)


def ingested(ranked: DataFrame, name: str) -> DataFrame:
    """A ranked table written as a raw file of the archive's shape (header
    names included) to the checkpoint folder, ingested, and read back."""
    spec, spark = SPECS[name], ranked.sparkSession
    folder = checkpoint_path(spark, f"rankwise-ingest-{uuid.uuid4().hex}")
    raw = ranked.select(*[F.col(dst).cast("string").alias(src) for src, dst, _ in spec.columns])
    raw.write.option("header", True).option("escape", '"').csv(os.path.join(folder, spec.raw_file))
    ingest_table(spark, os.path.join(folder, spec.raw_file), os.path.join(folder, name), spec)
    return spark.read.parquet(os.path.join(folder, name))
