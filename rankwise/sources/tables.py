"""Parquet scans of the input tables.

Reads are lazy: a ``Tables`` object only holds path names until an analysis
touches a table, and Catalyst then prunes columns and pushes filters into
each Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Attribute access to ``{base}/{name}.parquet`` (or ``{base}/{name}``)."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark = spark
        self._base = base
        self._cache: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def path(self, name: str) -> str:
        p = os.path.join(self._base, f"{name}.parquet")
        return p if os.path.exists(p) or "://" in self._base else os.path.join(self._base, name)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


def load_tables(spark: SparkSession, base: str) -> Tables:
    """Tables of ``base``; each call lists the files anew."""
    return Tables(spark, base)


def load_ranked(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four processed tables written by ``rankwise.sources.ingest``."""
    return {name: spark.read.parquet(os.path.join(base, name))
            for name in ("artists", "tracks", "albums", "users")}
