"""Naive plan vs rewritten plan for the analyses whose plan shape differs
(#6 long tail, #11/#12 itemsets, #16 stability, #5 statistics).

Usage: python scripts/compare_plans.py [sf_dir] [repeat]
Prints one JSON line: {name: {"naive": s, "rankwise": s}} (median seconds).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rankwise.operators import distribution as D  # noqa: E402
from rankwise.operators import itemsets as I  # noqa: E402
from rankwise.operators import lists as L  # noqa: E402
from rankwise.operators import popularity as P  # noqa: E402
from rankwise.plans.domain import views  # noqa: E402
from rankwise.session import local_session  # noqa: E402
from rankwise.sources.tables import load_tables  # noqa: E402


def naive_long_tail(a):
    m = a.groupBy("artist").agg(F.count(F.lit(1)).alias("m"))
    cum = m.withColumn("cum", F.sum("m").over(Window.orderBy(F.col("m").desc()))) \
           .withColumn("t", F.sum("m").over(Window.partitionBy(F.lit(1))))
    return cum.agg(F.count_if(F.col("cum") / F.col("t") <= 0.8).alias("n"), F.count(F.lit(1)).alias("t"))


def naive_stability(a):
    r1 = a.filter("rank = 1").select("user_id", F.col("artist").alias("a1"))
    r2 = a.filter("rank = 2").select("user_id", F.col("artist").alias("a2"))
    return r1.join(r2, "user_id").filter("a1 = a2").agg(F.count(F.lit(1)).alias("total"))


def naive_overlap(a, t):
    ta = a.filter("rank = 1").select("user_id", F.col("artist").alias("x"))
    tt = t.filter("rank = 1").select("user_id", F.col("artist").alias("y"))
    return ta.join(tt, "user_id").filter("x = y").agg(F.count(F.lit(1)).alias("o")).crossJoin(
        ta.agg(F.count(F.lit(1)).alias("n")))


def naive_top1(a):
    m = a.groupBy("artist").agg(F.count(F.lit(1)).alias("m"))
    top = m.orderBy(F.col("m").desc(), F.col("artist")).limit(5).select("artist")
    ones = a.filter("rank = 1").select("artist")
    return ones.join(top, "artist").agg(F.count(F.lit(1)).alias("h")).crossJoin(
        ones.agg(F.count(F.lit(1)).alias("n")))


def naive_heavy(t):
    heavy = t.groupBy("user_id").agg(F.count("track").alias("n")).filter("n > 40").select("user_id")
    return t.join(heavy, "user_id").groupBy("artist").agg(F.count(F.lit(1)).alias("c"))


def naive_stats(a):
    m = P.mentions(a, "artist")
    return m.agg(F.avg("menciones"), F.stddev("menciones")).crossJoin(
        m.agg(F.percentile_approx("menciones", 0.5)))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(argv[2]) if len(argv) > 2 else 3
    spark = local_session(8, 16)
    v = views(load_tables(spark, sf_dir))
    pairs = {
        "q06_long_tail": (lambda: naive_long_tail(v.artists), lambda: D.long_tail(v.artists, "artist")),
        "q11_artist_pairs": (lambda: I.frequent_itemsets(v.artists, "artist", 2, 50, prune=False),
                             lambda: I.frequent_itemsets(v.artists, "artist", 2, 50)),
        "q12_artist_triples": (lambda: I.frequent_itemsets(v.artists, "artist", 3, 20, prune=False),
                               lambda: I.frequent_itemsets(v.artists, "artist", 3, 20)),
        "q16_position_stability": (lambda: naive_stability(v.artists),
                                   lambda: L.position_stability(v.artists, "artist")),
        "q13_overlap": (lambda: naive_overlap(v.artists, v.track_head(1)),
                        lambda: L.top_overlap(v.artists, v.track_head(1))),
        "q15_top1_in_global5": (lambda: naive_top1(v.artists), lambda: L.top1_in_global(v.artists)),
        "q18_heavy_listeners": (lambda: naive_heavy(v.track_rows),
                                lambda: P.heavy_user_items(v.track_rows)),
        "q05_stats": (lambda: naive_stats(v.artists),
                      lambda: D.distribution_stats(P.mention_counts(v.artists, "artist"), "menciones")),
    }
    out = {}
    for name, fns in pairs.items():
        res = {}
        for label, fn in zip(("naive", "rankwise"), fns):
            fn().write.format("noop").mode("overwrite").save()      # warm
            runs = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn().write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            res[label] = round(statistics.median(runs), 3)
        out[name] = res
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
