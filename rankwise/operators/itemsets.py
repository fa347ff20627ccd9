"""Frequent item pairs and triples across users' lists (#11, #12).

The reference expanded every user's whole list into all 2- and
3-combinations with a Python UDF (disabled there, see SURVEY 2.10), which
emits sum(C(list length, size)) rows.  Here a basket is the set of distinct
non-NULL items of a user; rows without a user form one basket, as a grouping
by user makes of them.  Baskets and the support of every item are written
once, and every later step is planned from these tables:

1. The ``head`` items of highest support are counted first.  A basket over
   them is two 64-bit words (``bit_or``, a partial aggregate, so a user
   holding a third of all rows costs one small row per map task); an Arrow
   pass adds X^T X of the 0/1 rows.  The k-th best count there is a lower
   bound L of the k-th best count overall.
2. Only items with support >= L can be in a better tuple (every tuple is at
   most as frequent as its items).  If the head holds them all, it has the
   answer.  Else they are numbered by rising support and a basket becomes a
   sorted array of numbers; a long one is cut into slices of its first item,
   which go to different tasks.
3. A task adds up the pairs of its slices whose rarer item is outside the
   head, as packed numbers; each group of rarer items is summed up in one
   task, from the sorted parts of all others.  Only pairs that reach L become
   rows.
4. Triples are counted the same way, from pairs that reach L.  These pairs
   are known to the tasks by a bit table of fixed size: a wrong bit makes a
   triple counted in vain, never a wrong count, as a pair is left out for all
   baskets or for none.  The triples of the most frequent pairs come first
   and raise L before all others are counted.
5. The longest baskets (thousands of items, whose tuples grow with the square
   or cube), up to L of them, are not expanded: each adds one to a tuple at
   most.  The numbers of the items say which of them hold an item, and that is
   added to the counts of the others' tuples.  A tuple that no other basket
   holds reaches L only if all L baskets hold it; of those the first k by
   their items are enough.

``min_support`` leaves out tuples of fewer users.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize

USER = "user_id"
HEAD_ITEMS = 128           # two 64-bit words per user
FIRST_PAIRS = 2_000        # pairs whose triples raise the bound
_BITS = 64
_EXACT_ROWS = 1 << 20      # rows per float32 product: its sums stay far below 2**24
_HEAD_ID = 1 << 62         # ids from here on are the head's
_SLICE = 256               # first items of a slice
_STEP = 1 << 18            # tuples made at a time
_HELD = 1 << 21            # tuples a task holds before it adds them up
_LONG = 1 << 12            # items of a long basket, more than
_ASIDE = 8                 # long baskets set aside, at most
_ASIDE_K = 1_000           # best tuples asked for with a basket more aside, at most
_TABLE_BITS = 26           # bits of a pair table: 8 MB


def baskets(df: DataFrame, item: str = "artist") -> DataFrame:
    """Distinct (user, item) rows, NULL items dropped; the user may be NULL."""
    return df.filter(F.col(item).isNotNull()).select(USER, F.col(item).alias("item")).distinct()


def _names(size: int) -> list[str]:
    return [f"item_{i + 1}" for i in range(size)]


def _best(counts: DataFrame, size: int, k: int) -> DataFrame:
    return counts.orderBy(F.col("cnt").desc(), *[F.col(n).asc() for n in _names(size)]).limit(k)


# -- the head: dense products -------------------------------------------------

def _bits_of(words: np.ndarray) -> np.ndarray:
    """Rows of 64-bit words -> rows of 0/1 floats."""
    raw = np.ascontiguousarray(words.astype(np.int64))
    return np.unpackbits(raw.view(np.uint8), axis=1, bitorder="little").astype(np.float32)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((x.shape[1], y.shape[1]), dtype=np.int64)
    for at in range(0, len(x), _EXACT_ROWS):
        out += np.rint(x[at:at + _EXACT_ROWS].T @ y[at:at + _EXACT_ROWS]).astype(np.int64)
    return out


def _count_pairs(batches):
    """Co-occurrence of two head items over masks (w0, w1)."""
    for pdf in batches:
        x = _bits_of(pdf[["w0", "w1"]].to_numpy())
        c = np.triu(_products(x, x), 1)
        i, j = np.nonzero(c)
        yield pd.DataFrame(np.stack([i, j, c[i, j]], axis=1).astype(np.int64), columns=["b1", "b2", "cnt"])


def _count_triples(batches):
    """Co-occurrence of three head items over masks (w0, w1)."""
    for pdf in batches:
        x = _bits_of(pdf[["w0", "w1"]].to_numpy())
        found = []
        for i in np.flatnonzero(x.any(axis=0)):
            rows = x[x[:, i] == 1]
            c = np.triu(_products(rows, rows), 1)
            j, k = np.nonzero(c)
            keep = j > i
            found.append(np.stack([np.full(keep.sum(), i), j[keep], k[keep], c[j, k][keep]], axis=1))
        table = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        yield pd.DataFrame(table.astype(np.int64), columns=["b1", "b2", "b3", "cnt"])


def head_masks(b: DataFrame, top: DataFrame) -> DataFrame:
    """w0, w1: each basket over the head, from ``top`` (item, place)."""
    def word(number: int) -> Column:
        bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(place % 64 AS INT))")
        return F.coalesce(F.bit_or(F.when(F.floor(F.col("place") / _BITS) == number, bit)), F.lit(0).cast("bigint"))

    return (b.join(F.broadcast(top), "item").groupBy(USER).agg(word(0).alias("w0"), word(1).alias("w1"))
            .filter(F.bit_count("w0") + F.bit_count("w1") >= 2).select("w0", "w1"))


def _head_counts(masks: DataFrame, top: DataFrame, size: int) -> DataFrame:
    places = [f"b{i + 1}" for i in range(size)]
    counts = (masks.mapInPandas(_count_pairs if size == 2 else _count_triples, ", ".join(f"{p} long" for p in places) + ", cnt long")
              .groupBy(*places).agg(F.sum("cnt").alias("cnt")))
    for p in places:
        # HEAD_ITEMS rows
        counts = counts.join(F.broadcast(top.select(F.col("place").alias(p), F.col("item").alias(f"n_{p}"))), p)
    items = F.array_sort(F.array(*[f"n_{p}" for p in places]))
    return counts.select(*[items[i].alias(n) for i, n in enumerate(_names(size))], "cnt")


# -- the rest: sorted arrays of item numbers ------------------------------------

def _bit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The place of a pair in a bit table."""
    x, y = np.atleast_1d(x), np.atleast_1d(y)
    h = (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (y.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _TABLE_BITS)


def _has(table: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    at = _bit(x, y)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Cuts of a list whose sizes add up to about ``most`` each, one at least."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        yield slice(at, max(to, at + 1))
        at = max(to, at + 1)


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as its size says, and the number of the repeat."""
    index = np.repeat(np.arange(len(sizes)), sizes)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """values: the baskets of a batch end to end; places of the slices' first items, those outside the head,
    and how many items of its basket come after each."""
    for batch in batches:
        column = batch.column("items")
        ends, values = column.offsets.to_numpy(), column.values.to_numpy()
        start = ends[:-1] + batch.column("start").to_numpy()
        which, at = _spread(np.minimum(start + _SLICE, ends[1:]) - start)
        place = start[which] + at
        after = ends[1:][which] - 1 - place
        keep = (values[place] < _HEAD_ID) & (after > 0)
        yield values, place[keep], after[keep]


def pairs_of(values: np.ndarray, place: np.ndarray, after: np.ndarray) -> Iterator[np.ndarray]:
    """(x, y) for each first item x and every later item y of its basket."""
    for cut in _chunks(after, _STEP):
        which, at = _spread(after[cut])
        x = place[cut][which]
        yield np.stack([values[x], values[x + 1 + at]])


def triples_of(values: np.ndarray, place: np.ndarray, after: np.ndarray, table: np.ndarray,
               first: np.ndarray | None) -> Iterator[np.ndarray]:
    """(x, y, z), x a first item, all of whose pairs have their bit in ``table``; with ``first``: those
    with a pair (x, y) or (x, z) that has its bit there."""
    for cut in _chunks(after, _STEP):
        which, at = _spread(after[cut])
        y = values[place[cut][which] + 1 + at]
        x = values[place[cut]][which]
        known = np.flatnonzero(_has(table, x, y))
        x, y, which = x[known], y[known], which[known]
        end = np.searchsorted(which, which, side="right")       # of the rows of the same first item
        if first is None:
            left, begin = np.arange(len(x)), np.arange(1, len(x) + 1)
        else:
            leads = _has(first, x, y)
            left = np.flatnonzero(leads)
            begin = np.searchsorted(which, which[left], side="left")
        for part in _chunks(end[left] - begin, _STEP):
            of, nth = _spread(end[left][part] - begin[part])
            i, j = left[part][of], begin[part][of] + nth
            if first is not None:
                # a pair of leading items is found from each of them: it counts from the lower one
                keep = (i < j) | ((j < i) & ~leads[j])
                i, j = np.minimum(i[keep], j[keep]), np.maximum(i[keep], j[keep])
            both = np.flatnonzero(_has(table, y[i], y[j]))
            if len(both):
                yield np.stack([x[i[both]], y[i[both]], y[j[both]]])


class _Packed:
    """Tuples as one number each, dealt to groups by their first item.

    The numbers of a group are a range: sorted numbers are sorted by group.
    """

    def __init__(self, size: int, rest: int, head: int, groups: int):
        self.size, self.rest, self.base, self.groups = size, rest, rest + head, groups
        self.span = -(-self.base // groups)

    def fits(self) -> bool:
        return self.span * self.groups * self.base ** (self.size - 1) < 1 << 63

    def width(self) -> int:
        return self.span * self.base ** (self.size - 1)

    def keys(self, table: np.ndarray) -> np.ndarray:
        table = np.where(table >= _HEAD_ID, table - _HEAD_ID + self.rest, table)
        key = table[0] % self.groups * self.span + table[0] // self.groups
        for column in table[1:]:
            key = key * self.base + column
        return key

    def tuples(self, key: np.ndarray) -> list[np.ndarray]:
        parts = []
        for _ in range(self.size - 1):
            key, part = np.divmod(key, self.base)
            parts.append(part)
        parts.append(key % self.span * self.groups + key // self.span)
        return [np.where(p >= self.rest, p - self.rest + _HEAD_ID, p) for p in parts[::-1]]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, sorted, with their summed counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(key) else count


_GROUP_ROW = "g long, low long, steps binary, counts binary"


def _group_rows(key: np.ndarray, count: np.ndarray, packed: _Packed) -> pa.RecordBatch:
    """A row for each group: its lowest number, the steps between its numbers, their counts (none: all 1)."""
    group = key // packed.width()
    cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(key))
    steps, counts = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        step, c = np.diff(key[a:b], prepend=key[a]), count[a:b]
        steps.append((b"4" if step.max() < 1 << 32 else b"8") + step.astype(
            np.uint32 if step.max() < 1 << 32 else np.int64).tobytes())
        counts.append(b"" if (c == 1).all() else c.astype(np.int64).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(group[cuts[:-1]]), pa.array(key[cuts[:-1]]), pa.array(steps, pa.binary()),
                                       pa.array(counts, pa.binary())], ["g", "low", "steps", "counts"])


def _read_group_row(low: int, steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    step = np.frombuffer(steps, np.uint32 if steps[:1] == b"4" else np.int64, offset=1)
    key = np.cumsum(step, dtype=np.int64) + low
    return key, np.frombuffer(counts, np.int64) if counts else np.ones(len(key), np.int64)


def _summed(rows: DataFrame, tuples, size: int, rest: int, head: int, groups: int, bits: int = 0,
            least: int = 1, best: int | None = None) -> DataFrame:
    """x, y(, z), cnt of the tuples that ``tuples`` gives for every batch, of ``least`` users or more.

    A task adds up its tuples as packed numbers and sends each group of first
    items its sorted part; a group is added up in one task, so no tuple is a
    row before its count is known to reach ``least``.  The lowest ``bits``
    bits of an item's number say which baskets set aside hold it.  With
    ``best`` a group keeps what is as good as its ``best``-th tuple, ties
    included: nothing else of it can be among that many of all groups.
    """
    names, packed = list("xyz"[:size]), _Packed(size, rest, head, groups)
    schema = ", ".join(f"{c} long" for c in names) + ", cnt long"
    if not packed.fits():
        # too many items for one number: rows of the tuples
        def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                for table in tuples(*batch):
                    yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in table], pa.array(np.ones(table.shape[1], np.int64))],
                                                     [*names, "cnt"])

        sums = rows.mapInArrow(plain, schema).groupBy(*names).agg(F.sum("cnt").alias("cnt"))
        both = F.lit((1 << bits) - 1)
        for c in names:
            both = both.bitwiseAND(F.col(c))
        return sums.withColumn("cnt", F.col("cnt") + F.bit_count(both)).filter(F.col("cnt") >= least)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, sums = [], 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def add() -> None:
            nonlocal held, n, sums
            key, count = np.unique(np.concatenate(held), return_counts=True)
            sums = _merged([sums[0], key], [sums[1], count]) if len(sums[0]) else (key, count)
            held, n = [], 0

        for batch in _slices(batches):
            for table in tuples(*batch):
                held.append(packed.keys(table))
                n += len(held[-1])
                if n >= _HELD:
                    add()
                if len(sums[0]) >= _HELD // 2:
                    yield _group_rows(*sums, packed)
                    sums = (sums[0][:0], sums[1][:0])
        if n:
            add()
        if len(sums[0]):
            yield _group_rows(*sums, packed)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, now = [], [], None

        def found() -> pa.RecordBatch:
            key, count = _merged(keys, counts)
            if bits:
                parts = packed.tuples(key)
                both = np.full(len(key), (1 << bits) - 1, np.int64)
                for part in parts:
                    both &= part
                count = count + np.bitwise_count(both)
            enough = least
            if best is not None and len(count) > best:
                enough = max(least, int(np.partition(count, len(count) - best)[len(count) - best]))
            keep = count >= enough
            return pa.RecordBatch.from_arrays([*[pa.array(c) for c in packed.tuples(key[keep])], pa.array(count[keep].astype(np.int64))],
                                              [*names, "cnt"])

        for batch in batches:
            for g, low, steps, count in zip(*[batch.column(c) for c in ("g", "low", "steps", "counts")]):
                if now != g.as_py() and keys:
                    yield found()
                    keys, counts = [], []
                now = g.as_py()
                for held, part in zip((keys, counts), _read_group_row(low.as_py(), steps.as_py(), count.as_py())):
                    held.append(part)
        if keys:
            yield found()

    parts = max(min(groups, _tasks(rows.sparkSession)), groups // 8)
    return (rows.mapInArrow(send, _GROUP_ROW).repartition(parts, "g").sortWithinPartitions("g")
            .mapInArrow(receive, schema))


def _tasks(spark) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _groups(rows: DataFrame) -> int:
    """Groups of about ``_HELD`` pairs each; odd, so that no bit of a number decides alone."""
    n = F.size("items").cast("double")
    pairs = rows.filter(F.col("start") == 0).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).alias("n")).first()["n"]
    return max(_tasks(rows.sparkSession), int(pairs) // _HELD) | 1


def _bit_table(pairs: DataFrame) -> np.ndarray:
    """The bits of the pairs (x, y), of fixed size: words are joined in Spark, 64 bits each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column("x").to_numpy(), batch.column("y").to_numpy()))
            word = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(word.view(np.int64))],
                                             ["spot", "word"])

    rows = pairs.select("x", "y").mapInArrow(run, "spot long, word long").groupBy("spot").agg(
        F.bit_or("word").alias("word")).toArrow()
    table = np.zeros(1 << (_TABLE_BITS - 6), dtype=np.int64)
    table[rows.column("spot").to_numpy()] = rows.column("word").to_numpy()
    return table.view(np.uint8)


def _numbered(rest: DataFrame, top: DataFrame) -> tuple[DataFrame, int]:
    """(item, id): the rest from 0 by rising support, the head from _HEAD_ID; and the number of the rest.

    The sort is by range; each of its slices is numbered on its own and moved
    behind those before it, of which the driver gets one count each.
    """
    spread = materialize(rest.orderBy("sup", "item").select(
        "item", F.monotonically_increasing_id().alias("at")), "itemset-order").select(
        "item", F.shiftright("at", 33).alias("slice"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    sizes = {r["slice"]: r["count"] for r in spread.groupBy("slice").count().collect()}
    before, total = [], 0
    for k in sorted(sizes):
        before.append((k, total))
        total += sizes[k]
    offsets = rest.sparkSession.createDataFrame(before, "slice long, before long")
    numbered = spread.join(F.broadcast(offsets), "slice").select("item", (F.col("before") + F.col("at")).alias("id"))
    ids = numbered.unionByName(top.select("item", (F.col("place") + _HEAD_ID).alias("id")))
    return materialize(ids, "itemset-ids"), total


def _rest_rows(b: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """items (sorted numbers), start: the slices of baskets of at least ``size`` items, one of them outside the head."""
    items = b.join(ids, "item").groupBy(USER).agg(F.array_sort(F.collect_list("id")).alias("items"))
    items = materialize(items.filter((F.size("items") >= size) & (F.col("items")[0] < _HEAD_ID)).select("items"),
                        "itemset-baskets")
    short = F.size("items") <= _SLICE
    starts = F.explode(F.sequence(F.lit(0), F.size("items") - 1, F.lit(_SLICE)))
    slices = items.filter(short).select("items", F.lit(0).alias("start")).unionByName(
        items.filter(~short).select("items", starts.alias("start")))
    # few bytes, much work: a fixed number of tasks, which is not coalesced by size
    return slices.repartition(_tasks(b.sparkSession), "start", F.xxhash64("items"))


def _named(counts: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    for c in "xyz"[:size]:
        counts = counts.join(ids.select(F.col("id").alias(c), F.col("item").alias(f"n_{c}")), c)
    items = F.array_sort(F.array(*[f"n_{c}" for c in "xyz"[:size]]))
    return counts.select(*[items[i].alias(n) for i, n in enumerate(_names(size))], "cnt")


def _bound(counts: DataFrame, k: int, least: int) -> int:
    """The k-th best count, or ``least`` if there are fewer."""
    top = counts.select("cnt").orderBy(F.col("cnt").desc()).limit(k)
    row = top.agg(F.count(F.lit(1)).alias("n"), F.min("cnt").alias("cnt")).first()
    return max(least, row["cnt"]) if row["n"] >= k else least


def _set_aside(b: DataFrame, least: int, k: int) -> list:
    """Users (one may be NULL) of the longest baskets, no more than ``least``: a tuple in one of these
    only is then below ``least``, or in all of them."""
    most = min(_ASIDE, least if k <= _ASIDE_K else least - 1)
    sizes = b.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > _LONG)
    return [r[0] for r in sizes.orderBy(F.col("n").desc(), F.col(USER)).limit(most).select(USER).collect()]


def _marks(b: DataFrame, aside: list) -> tuple[DataFrame, DataFrame]:
    """(item, mark): a bit for each basket set aside that holds the item; and the other baskets."""
    mark = F.lit(0).cast("long")
    for n, user in enumerate(aside):
        mark = F.when(F.col(USER).eqNullSafe(F.lit(user)), F.lit(1 << n).cast("long")).otherwise(mark)
    marks = b.select("item", mark.alias("mark")).filter("mark > 0").groupBy("item").agg(F.bit_or("mark").alias("mark"))
    return materialize(marks, "itemset-marks"), b.filter(mark == 0)


def _common(marks: DataFrame, bits: int, size: int, k: int) -> DataFrame:
    """The first ``k`` tuples, by their items, that all baskets set aside hold, counted there only.

    They are made of the first k + size - 1 items.
    """
    items = marks.filter(F.col("mark") == (1 << bits) - 1).select("item").orderBy("item").limit(k + size - 1)
    names, out = _names(size), None
    for name in names:
        right = items.select(F.col("item").alias(name))
        out = right if out is None else out.join(F.broadcast(right), F.col(names[names.index(name) - 1]) < F.col(name))
    return out.orderBy(*names).limit(k).withColumn("cnt", F.lit(bits).cast("long"))


def _most(counts: DataFrame, size: int, bits: int) -> DataFrame:
    """Of a tuple counted in the baskets set aside only and in all baskets, the latter."""
    return counts.groupBy(*_names(size)).agg(F.max("cnt").alias("cnt")) if bits else counts


def _expand(b: DataFrame, size: int) -> DataFrame:
    """The plain definition: every strictly increasing tuple of every basket, counted."""
    names = _names(size)
    out = b.select(USER, F.col("item").alias(names[0]))
    for before, name in zip(names, names[1:]):
        right = b.select(F.col(USER).alias("u"), F.col("item").alias(name))
        out = out.join(right, F.col(USER).eqNullSafe(F.col("u")) & (F.col(before) < F.col(name))).drop("u")
    return out.groupBy(*names).agg(F.count(F.lit(1)).alias("cnt"))


def frequent_itemsets(df: DataFrame, item: str = "artist", size: int = 2, k: int = 50,
                      prune: bool = True, head: int = HEAD_ITEMS, min_support: int = 1) -> DataFrame:
    """The ``k`` item ``size``-sets held by most users, ties by the items.

    Columns ``item_1 .. item_<size>, cnt`` with ``item_1 < item_2 < ...``;
    sets of fewer than ``min_support`` users are left out (1: none).
    ``prune=False`` expands every basket with joins (the plain definition,
    kept for checks).  Baskets, supports and counts are written when this is
    called.
    """
    if size not in (2, 3) or not size <= head <= HEAD_ITEMS:
        raise ValueError(f"size must be 2 or 3, head {size} to {HEAD_ITEMS}")
    if not prune:
        return _best(_expand(baskets(df, item), size).filter(F.col("cnt") >= min_support), size, k)
    b = materialize(baskets(df, item), "itemset-rows")
    support = materialize(b.groupBy("item").agg(F.count(F.lit(1)).alias("sup")), "itemset-support")
    # at most ``head`` rows
    best_items = support.orderBy(F.col("sup").desc(), F.col("item").asc()).limit(head).collect()
    kind = support.schema["item"].dataType.simpleString()
    top = df.sparkSession.createDataFrame([(r["item"], n) for n, r in enumerate(best_items)], f"item {kind}, place long")
    masks = head_masks(b, top)
    counts = materialize(_head_counts(masks, top, size), "itemset-head")
    least = _bound(counts, k, max(1, min_support))
    first = counts.filter(F.col("cnt") >= min_support)
    rest = support.filter(F.col("sup") >= least).join(F.broadcast(top.select("item")), "item", "left_anti")
    if len(best_items) < head or rest.isEmpty():
        return _best(first, size, k)
    ids, n_rest = _numbered(rest, top)
    n_head = HEAD_ITEMS
    aside = _set_aside(b, least, k)
    bits = len(aside)
    if bits:
        marks, b = _marks(b, aside)
        pure = _common(marks, bits, size, k) if bits >= least else None
        # the lowest bits of a number: which baskets set aside hold the item
        of_id = F.coalesce("mark", F.lit(0).cast("long")) + F.when(
            F.col("id") < _HEAD_ID, F.shiftleft("id", bits)).otherwise(F.shiftleft(F.col("id") - _HEAD_ID, bits) + _HEAD_ID)
        ids = materialize(ids.join(marks, "item", "left").select("item", of_id.alias("id")), "itemset-marked")
        n_rest, n_head = n_rest << bits, n_head << bits
        if pure is not None:
            first = first.unionByName(pure)
    rows = _rest_rows(b, ids, size)
    groups = _groups(rows)
    pairs = _summed(rows, pairs_of, 2, n_rest, n_head, groups, bits, least, k if size == 2 else None)
    if size == 2:
        return _best(_most(first.unionByName(_named(pairs, ids, 2)), 2, bits), 2, k)
    pairs = materialize(pairs, "itemset-pairs")
    # head pairs are not told apart: their bits are all set
    head_ids = ids.filter(F.col("id") >= _HEAD_ID)
    in_head = head_ids.select(F.col("id").alias("x")).join(head_ids.select(F.col("id").alias("y")), F.col("x") < F.col("y"))
    table = _bit_table(pairs.select("x", "y").unionByName(in_head))
    leading = _bit_table(pairs.orderBy(F.col("cnt").desc(), "x", "y").limit(FIRST_PAIRS))
    early = _summed(rows, lambda *batch: triples_of(*batch, table, leading), 3, n_rest, n_head, groups, bits, least, k)
    raised = _bound(early.select("cnt").unionByName(counts.select("cnt")), k, least)
    if raised > least:
        table = _bit_table(pairs.filter(F.col("cnt") >= raised).select("x", "y").unionByName(in_head))
    others = _summed(rows, lambda *batch: triples_of(*batch, table, None), 3, n_rest, n_head, groups, bits, raised, k)
    return _best(_most(first.unionByName(_named(others, ids, 3)), 3, bits), 3, k)
