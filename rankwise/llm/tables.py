"""Scans and small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the class [\x20\x09-\x0D]: the only characters that separate words
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, by a path that only Spark has to reach."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operators use inside.

    Extra columns of the input are never carried, so their names cannot
    clash with those an operator adds.
    """
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
