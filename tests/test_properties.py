"""Seeded random lists: the scale rewrites equal the naive definitions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwise.functions.ranking import position_within
from rankwise.operators import distribution as D
from rankwise.operators import itemsets as I
from rankwise.operators import lists as L
from rankwise.operators import popularity as P
from rankwise.operators import sketches as S


def _random_lists(spark, seed, users=40, items=12, hot_user_rows=0, null_every=0):
    rnd = random.Random(seed)
    data = []
    for u in range(users):
        n = rnd.randint(1, items)
        picks = rnd.sample(range(items), n)
        for pos, it in enumerate(picks, start=1):
            name = None if null_every and rnd.randrange(null_every) == 0 else f"i{it:02d}"
            data.append((f"u{u:03d}", pos, name, rnd.randint(1, 50)))
    for pos in range(1, hot_user_rows + 1):
        data.append(("hot", pos, f"i{rnd.randrange(items):02d}", rnd.randint(1, 5)))
    return spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")


@pytest.mark.parametrize("batch", [5, 10000])
def test_range_positions_equal_window(spark, batch):
    """A hot group spread over many range partitions and Arrow batches gets
    the same row numbers as a per-group window."""
    # the list position is a unique tie-break inside a user
    df = _random_lists(spark, 7, users=60, hot_user_rows=400).withColumnRenamed("rank", "_k")
    order = [F.col("playcount").desc(), F.col("artist").asc_nulls_last(), F.col("_k").asc()]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        a = position_within(df, "user_id", order, "pos", strategy="window")
        b = position_within(df, "user_id", order, "pos", strategy="range")
        key = ["user_id", "_k"]
        ja = sorted(tuple(r) for r in a.select(*key, "pos").collect())
        jb = sorted(tuple(r) for r in b.select(*key, "pos").collect())
        assert ja == jb
        # the hot user really is split over several range partitions
        split = (df.repartitionByRange(8, "user_id", *order).filter("user_id = 'hot'")
                 .select(F.spark_partition_id()).distinct().count())
        assert split > 1
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_range_positions_null_groups(spark):
    df = spark.createDataFrame(
        [(None, 3), (None, 1), ("a", 2), ("a", 1), (None, 2), ("b", 9)], "g string, v int")
    got = sorted((r.g or "", r.v, r.pos) for r in
                 position_within(df, "g", [F.col("v").asc()], "pos", "range").collect())
    assert got == [("", 1, 1), ("", 2, 2), ("", 3, 3), ("a", 1, 1), ("a", 2, 2), ("b", 9, 1)]


def _naive_long_tail(df, share, mode):
    m = df.groupBy("artist").agg(F.count(F.lit(1)).alias("m"))
    total = F.sum("m").over(Window.partitionBy(F.lit(1)))
    if mode == "within":
        cum = F.sum("m").over(Window.orderBy(F.col("m").desc()))
        cond = (F.col("cum") / F.col("t")) <= share
    else:
        cum = F.sum("m").over(Window.orderBy(F.col("m").desc(), F.col("artist").asc_nulls_last())
                              .rowsBetween(Window.unboundedPreceding, 0))
        cond = ((F.col("cum") / F.col("t")) <= share) if mode == "within_rows" else \
            (((F.col("cum") - F.col("m")) / F.col("t")) < share)
    return m.withColumn("cum", cum).withColumn("t", total).agg(F.count_if(cond)).first()[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_long_tail_histogram_equals_naive(spark, seed, share):
    df = _random_lists(spark, seed, users=50, items=30, null_every=9)
    for mode in ("within", "within_rows", "reach"):
        got = D.long_tail(df, "artist", share, mode).first()[0]
        assert got == _naive_long_tail(df, share, mode), mode
    w = D.long_tail(df, "artist", share, "within").first()[0]
    r = D.long_tail(df, "artist", share, "reach").first()[0]
    assert w <= r


@pytest.mark.parametrize("seed", [4, 5])
def test_itemset_pruning_is_exact(spark, seed):
    df = _random_lists(spark, seed, users=60, items=14, null_every=11)
    for size, k in ((2, 7), (3, 9), (2, 500)):
        a = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, prune=True).collect()]
        b = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, prune=False).collect()]
        assert a == b


def test_position_stability_equals_self_join(spark):
    df = _random_lists(spark, 8, users=80, items=3)
    r1 = df.filter("rank = 1").select("user_id", F.col("artist").alias("a1"))
    r2 = df.filter("rank = 2").select("user_id", F.col("artist").alias("a2"))
    naive = r1.join(r2, "user_id").filter("a1 = a2").count()
    assert L.position_stability(df, "artist").first()[0] == naive


def test_results_do_not_depend_on_row_order(spark):
    df = _random_lists(spark, 9, users=50, items=10)
    shuffled = df.repartition(7, F.rand(11))
    for fn in (lambda d: P.top_items(d, "artist", 5),
               lambda d: L.duplicate_top_lists(d, "artist", 3),
               lambda d: D.distribution_stats(P.mentions(d, "artist"), "menciones")):
        assert [tuple(r) for r in fn(df).collect()] == [tuple(r) for r in fn(shuffled).collect()]


def test_mentions_sum_to_rows(spark):
    df = _random_lists(spark, 10, null_every=5)
    assert P.mentions(df, "artist").agg(F.sum("menciones")).first()[0] == df.count()


@pytest.mark.parametrize("head", [3, 6])
def test_itemsets_beyond_the_head_are_exact(spark, head):
    """A head smaller than the item domain leaves items to the blocks."""
    df = _random_lists(spark, 12, users=70, items=15, null_every=13)
    for size, k in ((2, 10), (3, 12)):
        a = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, head=head).collect()]
        b = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, prune=False).collect()]
        assert a == b, (size, k)


def test_overlap_equals_join_count(spark):
    """#13 as one aggregate equals the reference's join count, also with NULL
    users/artists and several rank-1 rows per user."""
    rnd = random.Random(21)
    def rows(n):
        return [(rnd.choice([None, "u1", "u2", "u3", "u4"]), 1,
                 rnd.choice([None, "A", "B", "C"]), 1) for _ in range(n)]
    schema = "user_id string, rank int, artist string, playcount bigint"
    a = spark.createDataFrame(rows(30), schema)
    t = spark.createDataFrame(rows(25), schema)
    ta = a.filter("rank = 1").select("user_id", F.col("artist").alias("x"))
    tt = t.filter("rank = 1").select("user_id", F.col("artist").alias("y"))
    naive = ta.join(tt, "user_id").filter("x = y").count()
    r = L.top_overlap(a, t).first()
    assert (r["solapamientos"], r["total_usuarios"]) == (naive, ta.count())


def test_top1_in_global_equals_join(spark):
    """#15 without a join equals the reference's join count, with a NULL
    item among the most mentioned and ties at the cut."""
    rnd = random.Random(33)
    data = [(f"u{rnd.randrange(12)}", rnd.choice([1, 1, 2, 3]), rnd.choice([None, None, "A", "B", "C", "D", "E", "F"]), 1)
            for _ in range(90)]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")
    for k in (1, 2, 5):
        m = df.groupBy("artist").agg(F.count(F.lit(1)).alias("m"))
        top = m.orderBy(F.col("m").desc(), F.col("artist").asc_nulls_last()).limit(k).select("artist")
        ones = df.filter("rank = 1").select("artist")
        naive = ones.join(top, "artist").count()
        r = L.top1_in_global(df, "artist", k).first()
        assert (r["total_usuarios"], r["usuarios_en_top5"]) == (ones.count(), naive), k


@pytest.mark.parametrize("counts,share", [
    ([1, 1, 1, 1], 0.5),          # cumulative share hits 0.5 exactly inside a tie group
    ([3, 1, 1, 1, 1, 1], 0.375),  # exactly at the end of the first group
    ([5, 5, 2, 2, 2, 2], 0.8),    # 16/18 crosses, 14/18 inside
    ([7], 0.8),                   # a single item
    ([2, 2, 2, 2, 2], 1.0),       # share 1: everything is within and reached
])
def test_long_tail_exact_boundaries(spark, counts, share):
    data = [(f"u{i}-{j}", 1, f"i{i:02d}", 1) for i, c in enumerate(counts) for j in range(c)]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")
    for mode in ("within", "within_rows", "reach"):
        assert D.long_tail(df, "artist", share, mode).first()[0] == _naive_long_tail(df, share, mode), mode


def test_itemset_min_support(spark):
    df = _random_lists(spark, 14, users=40, items=9)
    for size in (2, 3):
        all_sets = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, 10 ** 6).collect()]
        least = all_sets[len(all_sets) // 2][-1] + 1
        some = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, 10 ** 6, head=3, min_support=least).collect()]
        assert some == [r for r in all_sets if r[-1] >= least] and len(some) < len(all_sets)


def test_itemsets_of_more_blocks_and_a_hot_user(spark):
    """600 items, one user holding all of them: its basket is a few slices on several tasks."""
    rnd = random.Random(15)
    data = [(f"u{u}", p, f"i{rnd.randrange(600):03d}", 1) for u in range(60) for p in range(1, 9)]
    data += [("hot", p + 1, f"i{p:03d}", 1) for p in range(600)]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")
    a = [tuple(r) for r in I.frequent_itemsets(df, "artist", 2, 40).collect()]
    assert a == [tuple(r) for r in I.frequent_itemsets(df, "artist", 2, 40, prune=False).collect()]
    ids = I.baskets(df).select("item").distinct().withColumn("id", F.xxhash64("item").bitwiseAND(F.lit((1 << 60) - 1)))
    slices = I._rest_rows(I.baskets(df), ids, 2).filter(F.size("items") == 600)
    assert sorted(r.start for r in slices.collect()) == [0, I._SLICE, 2 * I._SLICE]
    assert slices.select(F.spark_partition_id().alias("task")).distinct().count() > 1


@pytest.mark.parametrize("head", [3, 5, 128])
def test_rows_without_a_user_are_one_basket(spark, head):
    rnd = random.Random(head)
    data = [(rnd.choice([None, None, *[f"u{u}" for u in range(30)]]), 1, f"i{rnd.randrange(12):02d}", 1) for _ in range(220)]
    data += [(None, 1, c, 1) for c in "ABC"] + [("u1", 1, c, 1) for c in "AB"] + [("u2", 1, c, 1) for c in "ABC"]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")
    held = defaultdict(set)
    for user, _, artist, _ in data:
        held[user].add(artist)
    for size, k in ((2, 30), (3, 40)):
        counts = Counter(t for items in held.values() for t in combinations(sorted(items), size))
        want = sorted(((*t, n) for t, n in counts.items()), key=lambda r: (-r[-1], r[:-1]))[:k]
        assert [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, head=head).collect()] == want
        assert [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, prune=False).collect()] == want


@pytest.mark.parametrize("first_pairs", [0, 3, 2000])
def test_triples_of_leading_pairs_are_counted_once(spark, first_pairs, monkeypatch):
    monkeypatch.setattr(I, "FIRST_PAIRS", first_pairs)
    rnd = random.Random(21)
    data = [(f"u{u}", 1, f"i{int(rnd.paretovariate(0.6)) % 40:02d}", 1) for u in range(120) for _ in range(12)]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, playcount bigint")
    a = [tuple(r) for r in I.frequent_itemsets(df, "artist", 3, 25, head=4).collect()]
    assert a == [tuple(r) for r in I.frequent_itemsets(df, "artist", 3, 25, prune=False).collect()]


def test_range_positions_keep_large_ids_and_nulls(spark):
    big = 2 ** 53
    data = [(u, v, None if v % 3 else v) for u in (big, big + 1, big + 2, big + 3, None) for v in range(7)]
    df = spark.createDataFrame(data, "user_id long, v long, payload long")
    for strategy in ("window", "range"):
        got = position_within(df, "user_id", [F.col("v").desc()], "pos", strategy)
        assert dict(got.dtypes)["pos"] == "bigint"
        assert {(r.user_id, r.v, r.payload, r.pos) for r in got.collect()} == {(u, v, p, 7 - v) for u, v, p in data}


def test_null_users_match_nothing(spark):
    """#13, #16 and #18 with rows without a user equal the reference's inner joins."""
    rnd = random.Random(44)
    data = [(rnd.choice([None, "u1", "u2", "u3"]), rnd.choice([1, 2]), rnd.choice([None, "A", "B"]), rnd.choice([None, "t1", "t2"]))
            for _ in range(120)]
    df = spark.createDataFrame(data, "user_id string, rank int, artist string, track string")
    one, two = (df.filter(f"rank = {r}").select("user_id", F.col("artist").alias(f"a{r}")) for r in (1, 2))
    assert L.position_stability(df, "artist").first()[0] == one.join(two, "user_id").filter("a1 = a2").count()
    counts = df.groupBy("user_id").agg(F.count("track").alias("n")).filter("n > 20").select("user_id")
    naive = df.join(counts, "user_id").groupBy("artist").count()
    got = P.heavy_user_items(df, "artist", 20)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in naive.collect()}


@pytest.mark.parametrize("n", [1, 7, 1_000_000])
def test_exact_quantiles(spark, n):
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("x"))
    df = df.unionAll(df.limit(0)).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = D.exact_quantiles(df, "x", (0.01, 0.5, 0.99)).first()
    assert [got[0], got[1], got[2]] == [float(max(1, -(-int(n * q * 100) // 10000)) - 1) for q in (1, 50, 99)]


def test_distinct_counts_merge_from_stored_sketches(spark):
    """Two halves sketched apart give the count of the whole, within the stated error."""
    df = spark.range(60_000).select((F.col("id") % 2).alias("half"), (F.col("id") % 20_011).alias("many"),
                                    F.when(F.col("id") % 7 > 0, F.concat(F.lit("i"), F.col("id") % 7)).alias("few"),
                                    F.lit(None).cast("string").alias("none"))
    halves = [S.distinct_sketches(df.filter(F.col("half") == h), ["many", "few", "none"], "half") for h in (0, 1)]
    r = S.distinct_estimates(halves[0].unionByName(halves[1]), {"many": "m", "few": "f", "none": "n"}).first()
    assert abs(r.m - 20_011) <= S.ERROR * 20_011 and (r.f, r.n) == (6, 0)
    # a slice alone, and no slice at all
    assert S.distinct_estimates(halves[0], {"few": "f"}).first().f == 6
    assert S.distinct_estimates(halves[0].filter("false"), {"many": "m"}).first().m == 0


@pytest.mark.parametrize("least_two", [False, True])
def test_long_baskets_are_not_expanded(spark, monkeypatch, least_two):
    """rows without a user make one basket of thousands of items; it is set aside, and every tuple still counted."""
    monkeypatch.setattr(I, "_LONG", 30)
    rnd = random.Random(11)
    rows = [(None, f"a{i:03d}") for i in rnd.sample(range(90), 70)] + [("hot", f"a{i:03d}") for i in rnd.sample(range(90), 60)]
    if least_two:
        rows += [(f"u{u}", f"a{i:03d}") for u in range(40) for i in rnd.sample(range(90), 6)]
    df = spark.createDataFrame(rows, "user_id string, artist string")
    sent = []
    rest_rows = I._rest_rows
    monkeypatch.setattr(I, "_rest_rows", lambda *a: sent.append(rest_rows(*a)) or sent[-1])
    for size, k in ((2, 40), (3, 15), (2, 3000)):
        a = [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, head=3).collect()]
        assert a == [tuple(r) for r in I.frequent_itemsets(df, "artist", size, k, prune=False).collect()]
    longest = [max((len(r["items"]) for r in rows.select("items").collect()), default=0) for rows in sent]
    assert longest[0] < 70 and len(sent) == 3


def test_a_slice_is_expanded_step_by_step(monkeypatch):
    """pairs and triples of a batch are made some at a time, whatever the length of a basket."""
    monkeypatch.setattr(I, "_STEP", 64)
    rnd = random.Random(5)
    lists = [sorted(rnd.sample(range(60), n)) for n in (2, 50, 1, 17)]
    lists[1][-3:] = [I._HEAD_ID, I._HEAD_ID + 1, I._HEAD_ID + 4]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64())), pa.array([0] * 4, pa.int64())], ["items", "start"])
    want = sorted((x, y) for items in lists for x, y in combinations(items, 2) if x < I._HEAD_ID)
    parts = [part for b in I._slices([batch]) for part in I.pairs_of(*b)]
    assert max(part.shape[1] for part in parts) <= 64
    assert sorted(zip(*np.concatenate(parts, axis=1).tolist())) == want
    table = np.full(1 << (I._TABLE_BITS - 3), 255, np.uint8)
    for first in (None, table):
        found = [part for b in I._slices([batch]) for part in I.triples_of(*b, table, first)]
        assert sorted(zip(*np.concatenate(found, axis=1).tolist())) == sorted(
            t for items in lists for t in combinations(items, 3) if t[0] < I._HEAD_ID)


@pytest.mark.parametrize("groups, rest", [(1, 60), (7, 60), (7, 1 << 33)])
def test_packed_tuples_sum_up(spark, groups, rest):
    """packed numbers, dealt to groups, and rows where a number has no room, give the plain counts."""
    rnd = random.Random(groups)
    lists = [sorted(rnd.sample(range(60), 12)) + [I._HEAD_ID + 3] for _ in range(50)]
    rows = spark.createDataFrame([(items, 0) for items in lists], "items array<long>, start int")
    want = Counter(p for items in lists for p in combinations(items, 2))
    found = I._summed(rows, I.pairs_of, 2, rest, I.HEAD_ITEMS, groups, 0, 3).collect()
    assert {(r.x, r.y): r.cnt for r in found} == {p: c for p, c in want.items() if c >= 3}
