"""Command line: the two batch jobs of the reference, on Spark.

    python -m rankwise ingest RAW_DIR OUT_DIR [--users-file NAME]
    python -m rankwise export PROCESSED_DIR RESULTS_DIR
    python -m rankwise export-derived TABLES_DIR RESULTS_DIR [--stage DIR]
    python -m rankwise export PROCESSED_DIR --jdbc-url URL [--jdbc-option k=v ...] [--keys]

``export`` reads the four ranked tables written by ``ingest``;
``export-derived`` derives them from star-schema tables first.  Results go
to Parquet folders or, with ``--jdbc-url``, to JDBC tables (credentials as
``--jdbc-option user=...``; nothing is hard-coded).  ``--wide`` stores counts
as BIGINT and means as DECIMAL(28,4); ``--keys`` declares primary keys on new
JDBC tables.  Every stored table is read back and checked against the contract.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from rankwise.plans.domain import list_views, views
from rankwise.plans.export import export_all
from rankwise.session import ensure_checkpoint_dir
from rankwise.sources.ingest import ingest
from rankwise.sources.sinks import read_result, write_result_jdbc, write_result_parquet
from rankwise.sources.tables import load_ranked, load_tables


def _sink(args, spark):
    """The sink of the results, and how to read one back."""
    if args.jdbc_url:
        props = dict(kv.split("=", 1) for kv in args.jdbc_option)
        return (lambda df, t: write_result_jdbc(df, t, args.jdbc_url, props, wide=args.wide, keys=args.keys),
                lambda t: read_result(spark, t, jdbc_url=args.jdbc_url, properties=props))
    if not args.results:
        raise SystemExit("give RESULTS_DIR or --jdbc-url")
    return (lambda df, t: write_result_parquet(df, args.results, t, args.wide),
            lambda t: read_result(spark, t, args.results))


def _report(done) -> None:
    for table, r in done.items():
        faults = {k: r[k] for k in ("null_keys", "duplicate_keys", "too_long") if r[k]}
        print("written", table, r["rows"], "rows", faults or "")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="rankwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("raw_dir")
    i.add_argument("out_dir")
    i.add_argument("--users-file", default=None)
    for name in ("export", "export-derived"):
        e = sub.add_parser(name)
        e.add_argument("source")
        e.add_argument("results", nargs="?")
        e.add_argument("--jdbc-url")
        e.add_argument("--jdbc-option", action="append", default=[])
        e.add_argument("--stage")
        e.add_argument("--wide", action="store_true")
        e.add_argument("--keys", action="store_true")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"rankwise-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "ingest":
        files = {"users": args.users_file} if args.users_file else None
        report = ingest(spark, args.raw_dir, args.out_dir, files)
        report.show(truncate=False)
    else:
        v = (list_views(load_ranked(spark, args.source)) if args.cmd == "export"
             else views(load_tables(spark, args.source)))
        sink, read_back = _sink(args, spark)
        _report(export_all(v, sink, stage_dir=args.stage, read_back=read_back))
    return 0


if __name__ == "__main__":
    sys.exit(main())
