"""Mixing sources to target weights.

Sizes are counted in words.  Every source has a weight and a ceiling of
``max_repeat`` times its own size; the total size of all sources is shared
by weight, a source that would pass its ceiling stops there and the excess
is shared again by weight among the others, until none is above.  A
document of a source with rate = target / size is taken floor(rate) times,
plus once more with probability rate - floor(rate), decided by a hash of
its id: reruns agree, and no global state is needed.

The per-source totals are map-side sums, so a source that holds a third of
all rows costs one row per task.  Only the source table (one row per
source) is sorted, range-partitioned, to number the sources; the ceilings
are settled by repeated one-row sums over it, never by a collect of it.

Defined cases: a null text has size 0.  A null source is a source of its
own, after all others.  Documents with a null id share one draw; repeated
rows draw alike.  An empty table, or one without words, takes nothing:
targets are 0.  Extra columns are not carried by ``mix``; ``repeat_rows``
carries them.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.tables import WORD, free_name, pick, text_of

#: bits of the MD5 that decide the extra copy
DRAW_BITS = 52


def draw(id_column: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    key = F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, DRAW_BITS // 4), 16, 10).cast("bigint") / F.lit(float(2 ** DRAW_BITS))


def numbered_sources(sources: DataFrame) -> DataFrame:
    """``ordinal`` 0, 1, ... in code point order of the source, null last.

    The order is found by a range sort; what reaches the driver is one count
    per partition.
    """
    # the flag sorts first: a null source comes after every name
    parted = materialize(
        sources.withColumn("absent", F.col("source").isNull())
        .repartitionByRange(F.col("absent"), F.col("source").asc_nulls_last())
        .sortWithinPartitions("absent", F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = {r["part"]: r["n"] for r in parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = dict(zip(sorted(counts), accumulate([0, *[counts[p] for p in sorted(counts)]])))
    offset = F.create_map(*[F.lit(x) for kv in first.items() for x in kv]) if first else None
    local = F.row_number().over(
        Window.partitionBy("part").orderBy("absent", F.col("source").asc_nulls_last())) - 1
    start = offset[F.col("part")] if first else F.lit(0)
    return parted.withColumn("ordinal", (start + local).cast("bigint")).drop("part", "absent")


def targets(sources: DataFrame, weights: list[int], max_repeat: int) -> DataFrame:
    """source, source_size, target from (source, source_size).

    ``target`` = weight * (what is left for the uncapped / their weights), or
    the ceiling.  Every round shares again among the sources still below
    theirs; a round that caps nothing ends the loop, so there are at most as
    many rounds as sources, and in practice a few.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("ordinal") % len(weights)).cast("int") + 1)
    rows = materialize(numbered_sources(sources).withColumn("weight", weight.cast("bigint")), "mix-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    ceiling = F.lit(max_repeat) * F.col("source_size")
    left, open_weights = total, rows.agg(F.sum("weight")).first()[0] or 0
    while open_weights:
        # target > ceiling as whole numbers: weight * left > ceiling * open weights
        above = F.col("weight").cast("decimal(38,0)") * F.lit(left) > ceiling.cast("decimal(38,0)") * F.lit(open_weights)
        capped = rows.agg(F.coalesce(F.sum(F.when(above, ceiling)), F.lit(0)).alias("size"),
                          F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights")).first()
        if capped["weights"] == open_weights or not capped["weights"]:
            break
        left, open_weights = total - capped["size"], capped["weights"]
    share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(open_weights or 1))
    return rows.select("source", "source_size", F.least(share, ceiling.cast("double")).alias("target"))


def mix(docs: DataFrame, weights: list[int] = (1, 2, 3), max_repeat: int = 3, seed: int = 20,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken: one row per input row."""
    sized = pick(docs, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = targets(sources, list(weights), max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (draw(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate")).cast("bigint")
    share = shares.withColumnRenamed("source", "share_of")
    return (sized.join(share, F.col("source").eqNullSafe(F.col("share_of")))
            .withColumn("rate", rate)
            .withColumn("copies", F.floor("rate") + extra)
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"), "source"))


def repeat_rows(docs: DataFrame, weights: list[int] = (1, 2, 3), max_repeat: int = 3, seed: int = 20,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus itself: every row as often as the mix takes it, with all its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    of, rate, times, copy = (free_name(docs, n) for n in ("source_of", "rate", "times", "copy"))
    size = F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("bigint")
    sources = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.sum(size).alias("source_size"))
    share = targets(sources, list(weights), max_repeat).select(
        F.col("source").alias(of),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias(rate))
    extra = (draw(F.col(f"`{id_col}`"), seed) < F.col(rate) - F.floor(rate)).cast("int")
    return (docs.join(share, docs[source_col].eqNullSafe(share[of]))
            .withColumn(times, F.floor(rate).cast("int") + extra).filter(F.col(times) > 0)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy))
            .select(*columns))
