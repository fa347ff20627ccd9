"""Cut a long lineage by writing a table to the shared checkpoint folder.

The folder is the one the cluster names in ``spark.checkpoint.dir`` (see
``rankwise.session.ensure_checkpoint_dir``); it is shared storage, so a
lost executor does not lose the table, unlike a local checkpoint.  Parquet
keeps the table columnar, so later scans still prune columns and push
filters.

A table lives as long as what reads it.  A job that consumes its results
itself wraps them in ``workspace``, which removes the tables at its end.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rankwise.session import checkpoint_path

_OPEN: list[str] = []


@contextmanager
def workspace(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Tables materialized inside go to one folder (by default a new one under
    the checkpoint folder), removed at the end."""
    path = folder or checkpoint_path(spark, f"rankwise-work-{uuid.uuid4().hex}")
    _OPEN.append(path)
    try:
        yield path
    finally:
        _OPEN.pop()
        drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more, wherever Spark wrote it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    table = f"rankwise-{name}-{uuid.uuid4().hex}"
    path = os.path.join(_OPEN[-1], table) if _OPEN else checkpoint_path(spark, table)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
