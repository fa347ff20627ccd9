"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups.

Two texts are equal when they agree after every run of white space
(``[\\x20\\x09-\\x0D]+``) became one space.  All work is built-in SQL functions.

1. Every distinct normalised text is reduced, map side first, to one row
   (hash, smallest id, number of rows).  The grouping key is the MD5 *and*
   the text, so bytes are compared inside a hash group: two texts that
   collide in MD5 stay two groups.
2. The texts are dropped; (MD5, SHA-256) names each group from here on.
3. Every row finds its group by that pair.  A group that holds a third of
   all rows is a skewed inner join of a thin side (ids and two hashes, no
   text) with one row per group, which adaptive execution splits.

Defined cases: a null text is an empty text.  Null ids sort after all
others, so such a row stays only if every row of its group has none.  A very
long text is hashed and compared whole.  Of repeated rows (same id, same text) exactly one stays; each input row gives
one result row.  An empty table gives an empty result.  Extra columns are
not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.llm.tables import SPACE, free_name, pick, text_of


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    base = pick(docs, doc_id=id_col, text=text_col).select("doc_id", normalised(text_of()).alias("norm"))
    hashed = base.select("doc_id", F.unhex(F.md5("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("s"), "norm",
                         F.spark_partition_id().alias("part"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "part")
    groups = (hashed.groupBy("h", "norm").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
              .select("h", F.unhex(F.sha2("norm", 256)).alias("s"), F.col("first.doc_id").alias("keep_id"),
                      F.col("first.part").alias("keep_part"), "group_size"))
    # rows with the same id and text fall together within an input partition, so that one of them stays;
    # their number is bounded by the partition's rows
    members = hashed.groupBy("h", "s", "doc_id", "part").agg(F.count(F.lit(1)).alias("copies"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("part") == F.col("keep_part"))
    return (members.join(groups, ["h", "s"])
            .select("doc_id", "keep_id", "group_size", "s", stays.alias("stays"), copy)
            .select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("s")).alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Repeated rows (same id and text) become one.  The key of a row is its id
    as text (a null id has a mark of its own) and the SHA-256 of its text.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, sha = free_name(docs, "key"), free_name(docs, "sha")
    kept = exact_dedup(docs, id_col, text_col).filter("kept")
    named = lambda c: F.coalesce(c.cast("string"), F.lit("\u0000"))
    kept = kept.select(named(F.col("doc_id")).alias(key), F.col("text_sha256").alias(sha))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*columns, named(F.col(f"`{id_col}`")).alias(key), F.sha2(normalised(text), 256).alias(sha))
    return rows.join(kept, [key, sha], "left_semi").dropDuplicates([key, sha]).select(*columns)
