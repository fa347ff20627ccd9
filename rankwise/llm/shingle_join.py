"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its word 5-grams ("tokens" below, 64-bit hashes).
Two documents link when 100 * |A & B| >= percent * |A | B|.  All tokens have one
global order, rare ones first, by a sketch of document frequencies (one
counter per hash bucket, summed over the whole corpus, so it never
underestimates; a wrong estimate costs time, never a link).  Linked sets
share a token in their prefixes of n - ceil(percent * n / 100) + 1 tokens, and
k tokens when the prefixes are k - 1 longer.

1. One pass counts: the sketch, and a signature of every set.  Documents of
   one signature are copies: one edge each to the smallest id.
2. One pass indexes single tokens of the prefixes.  Tokens only one document
   has go at once; in the bucket of any other token, every member is compared
   with the smallest one (a star, linear in the bucket).
3. Buckets whose members the links so far do not join are open.  Where at most
   ``small`` members are outside the largest component, these strays are
   compared with the members of other components, if what follows the token in
   both orders is long enough for the overlap (as it is in the bucket of the
   pair's first common token).  Others are classes of frequent tokens: their members are indexed anew by
   combinations of one more token of the extended prefix, and steps 2 and 3
   repeat on these.  After ``depth`` tokens what is still open is compared
   pair by pair across components, by a join that can be split.
4. Before texts are fetched, a pair must pass two bounds that no similar pair
   fails: on the set sizes, and on the symmetric difference, which is at least
   the number of bits in which the sets' parity bitmaps differ.
5. Comparing is exact, on the sets of the two whole texts.

So all links that decide components are found, while a group of thousands of
(near) copies costs a few comparisons per member, never all its pairs.

Defined cases: a null or empty text has no tokens and links with nothing.
Rows that share an id are one node; rows with a null id are not linked and
have no component.  Repeated rows give repeated results; extra columns are
not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.blocks import blocks, words_of
from rankwise.llm.components import components
from rankwise.llm.hashing import mixed, prefix_sums, substring_hashes
from rankwise.llm.tables import pick

#: counters of the frequency sketch (4 bytes each, on the driver and in each worker)
SKETCH_BITS = 20
_CHUNK = 1 << 12
#: tokens in the index are cut to 48 bits; what that confuses, comparing tells apart
_TOKEN_SHIFT = np.uint64(16)

#: bits of a set's parity bitmap: bit i says whether an odd number of tokens hash to i
PARITY_BITS = 1024
#: texts to compare are picked by a broadcast of their ids up to this many (8 bytes each)
BROADCAST_IDS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.array([0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                  0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row of a block, the sorted distinct hashes of its shingles."""
    data = _LOWER[data]
    starts, stops, first = words_of(data, offsets)
    words = substring_hashes(prefix_sums(data), starts, stops) if len(starts) else np.zeros(0, np.uint64)
    steps = [int(_STEP[j % len(_STEP)]) ^ (j // len(_STEP)) for j in range(size)]
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        grams += words[j:j + n] * np.uint64(steps[j] | 1)
    grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:     # fewer words: the whole sequence is one shingle
            whole = sum(int(w) * (s | 1) for w, s in zip(words[a:b].tolist(), steps)) + 0x51ED27 * (b - a)
            out.append(mixed(np.array([whole & (1 << 64) - 1], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set only."""
    return int(tokens.sum(dtype=np.uint64)), int(mixed(tokens ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64))


def parity(tokens: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as 64-bit numbers."""
    odd = np.bincount((tokens & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for non-empty sets."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _buckets_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _ordered(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The tokens of a set in global order: estimated frequency, then hash."""
    return tokens[np.argsort(sketch[_buckets_of(tokens)], kind="stable")]


def _index_key(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> _TOKEN_SHIFT).astype(np.int64)


#: an index row; within a document of n tokens, pos is the key's place in the global order
INDEX = "key long, id long, n int, pos int"


def count_sets(rows: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, sig1, sig2, bits) of every row, and the sketch of all tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        names = ["doc_id", "n", "sig1", "sig2", "bits", "chunk", "counts"]
        bitmap = pa.list_(pa.int64())
        for batch in batches:
            for row, stop, data, offsets in blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                if sets:
                    sketch += np.bincount(_buckets_of(np.concatenate(sets)), minlength=len(sketch))
                k = stop - row
                sig1, sig2 = np.array([signature(s) for s in sets], dtype=np.uint64).reshape(k, 2).T.copy().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, k).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(sig1), pa.array(sig2), pa.array([parity(s) for s in sets], bitmap),
                     pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        used = [c for c in range(len(sketch) // _CHUNK) if sketch[c * _CHUNK:(c + 1) * _CHUNK].any()]
        raw = [sketch[c * _CHUNK:(c + 1) * _CHUNK].astype("<u4").tobytes() for c in used]
        k = len(used)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(k, pa.int64())] * 4, pa.nulls(k, bitmap), pa.array(used, pa.int32()), pa.array(raw, pa.binary())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total.setdefault(c, np.zeros(_CHUNK, np.int64))
                total[c] += np.frombuffer(raw, "<u4" if len(raw) == 4 * _CHUNK else "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([x.astype("<i8").tobytes() for x in total.values()], pa.binary())],
                                         ["chunk", "counts"])

    kinds = "doc_id long, n long, sig1 long, sig2 long, bits array<long>, chunk int, counts binary"
    out = materialize(rows.mapInArrow(run, kinds), "shingle-counts")
    chunks = out.filter("chunk is not null").select("chunk", "counts")
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    # one row per chunk reaches the driver: 8 bytes per counter whatever the corpus
    for r in chunks.repartition("chunk").mapInArrow(add, "chunk int, counts binary").collect():
        sketch[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["counts"], "<i8")
    sets = out.filter("chunk is null").select("doc_id", F.col("n").alias("n_shingles"), "sig1", "sig2", "bits")
    return sets, np.minimum(sketch, np.iinfo(np.int32).max).astype(np.int32)


def index_prefixes(rows: DataFrame, sketch, size: int, percent: int) -> DataFrame:
    """key, id, n, pos for the prefix tokens of every set: its size and the token's place in its order.

    Of copies in one batch only the first is indexed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sketch.value
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
            seen: set[tuple] = set()
            for row, _, data, offsets in blocks(batch.column("text")):
                keys, owners, sizes, places = [], [], [], []
                for i, tokens in enumerate(shingle_sets(data, offsets, size), row):
                    mark = (len(tokens), *signature(tokens))
                    if not len(tokens) or mark in seen:
                        continue
                    seen.add(mark)
                    part = _ordered(tokens, order)[:prefix_length(len(tokens), percent)]
                    keys.append(_index_key(part))
                    owners.append(np.full(len(part), ids[i], dtype=np.int64))
                    sizes.append(np.full(len(part), len(tokens), dtype=np.int32))
                    places.append(np.arange(len(part), dtype=np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, owners, sizes, places)],
                                                     ["key", "id", "n", "pos"])

    return rows.mapInArrow(run, INDEX)


def shared_buckets(index: DataFrame) -> DataFrame:
    """The index rows of keys that several documents have, with ``pivot``, the smallest id of the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot, told = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            rows = [c.to_numpy() for c in batch.columns]
            carried = last is not None
            if carried:     # the last row of the batch before goes first
                rows = [np.append(np.array([x], dtype=c.dtype), c) for x, c in zip(last, rows)]
            fresh = np.ones(len(rows[0]), dtype=bool)
            fresh[1:] = np.any([c[1:] != c[:-1] for c in rows], axis=0)     # the same row twice is one member
            rows = [c[fresh] for c in rows]
            keys, ids = rows[0], rows[1]
            new = np.ones(len(keys), dtype=bool)
            new[1:] = keys[1:] != keys[:-1]
            heads = np.flatnonzero(new)
            first = ids[heads].copy()
            if carried:
                first[0] = pivot
            pivots = np.repeat(first, np.diff(np.append(heads, len(keys))))
            many = ~new
            many[:-1] |= ~new[1:]
            if carried and told:
                many[0] = False     # it was given out with its batch
            last, pivot = [c[-1] for c in rows], pivots[-1]
            told = bool(many[-1]) or (carried and told and len(keys) == 1)
            at = np.flatnonzero(many)
            yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in [*rows, pivots]], [*names, "pivot"])

    return index.repartition("key").sortWithinPartitions("key", "id", "n", "pos").mapInArrow(run, f"{INDEX}, pivot long")


def _texts(rows: DataFrame, ids: DataFrame, at_most: int) -> DataFrame:
    """id, text of the documents in ``ids`` (doc_id), of which there are ``at_most``."""
    if at_most <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text")


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and parity bitmaps allow the similarity."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("bits").alias(f"bits{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    differ = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    total = F.col("na") + F.col("nb")
    # |A & B| <= (total - differ) / 2, and similarity asks for (100 + percent) * |A & B| >= percent * total
    return both.filter((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                       & ((100 + percent) * (total - differ) >= 2 * percent * total)).select("a", "b").distinct()


def compare(pairs: DataFrame, sets: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their whole texts, as a written table."""
    pairs = materialize(plausible(pairs, sets, percent), "shingle-pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    texts = _texts(rows, ids, 2 * pairs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[s for _, _, data, offsets in blocks(batch.column(c)) for s in shingle_sets(data, offsets, size)]
                     for c in ("ta", "tb")]
            at = pa.array([i for i, (x, y) in enumerate(zip(*sides)) if linked(x, y, percent)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    one = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a")
    two = one.join(texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b")
    return materialize(two.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct(), "shingle-edges")


def _combination_keys(part: np.ndarray, have: set[int], k: int) -> np.ndarray:
    """Keys of k + 1 of the tokens that contain k tokens whose key is in ``have``.

    The key of one token is the token, that of several depends on their sum.
    """
    out: list[np.ndarray] = []
    for chosen in combinations(range(len(part)), k):
        total = part[list(chosen)].sum(dtype=np.int64)
        key = total if k == 1 else mixed(np.array([total]).astype(np.uint64)).view(np.int64)[0]
        if int(key) in have:
            rest = np.delete(part, list(chosen))
            out.append(mixed((rest + total).astype(np.uint64)).view(np.int64))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _deeper(members: DataFrame, rows: DataFrame, sketch, size: int, percent: int, k: int) -> DataFrame:
    """Index rows: the open combinations of k tokens of each document, with one more token of the extended prefix.

    ``members`` has (id, keys): for each document the keys of its open buckets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sketch.value
        for batch in batches:
            open_keys, ids = batch.column("keys").to_pylist(), batch.column("id").to_pylist()
            for row, _, data, offsets in blocks(batch.column("text")):
                for i, tokens in enumerate(shingle_sets(data, offsets, size), row):
                    part = _index_key(_ordered(tokens, order)[:prefix_length(len(tokens), percent) + k])
                    keys = _combination_keys(part, set(open_keys[i]), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), *[pa.array(np.full(len(keys), x, dtype=t)) for x, t in
                                           ((ids[i], np.int64), (len(tokens), np.int32), (0, np.int32))]],
                        ["key", "id", "n", "pos"])

    texts = _texts(rows, members.select(F.col("id").alias("doc_id")), members.count())
    return members.join(texts, "id").select("id", "keys", "text").mapInArrow(run, INDEX)


def _room(room, total, percent: int):
    """Whether ``room`` tokens can hold the overlap that two sets of ``total`` tokens need."""
    return (100 + percent) * room >= percent * total


def _open_buckets(placed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of buckets with several components: the strays, members outside the largest
    component, and the members that may be similar to a stray of the bucket.

    A pair is looked for in the bucket of its first common token, where the
    rest of both orders (``room``) must hold the whole overlap.  So only
    members count whose room is enough beside the sizes in the bucket, and
    buckets without such a stray go.  The pivot was compared with all.
    """
    rows = placed.withColumn("room", F.col("n") - F.col("pos"))
    parts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least_n"))
    mixed_keys = (parts.groupBy("key").agg(F.sum("rows").alias("members"), F.max(F.struct("rows", "component")).alias("main"),
                                           F.min("least_n").alias("least_n"))
                  .filter("members > 2 and main.rows < members")
                  .select(F.col("key").alias("of"), F.col("main.component").alias("main"), "least_n"))
    smallest = F.greatest("least_n", F.ceil(percent * F.col("n") / 100))
    strays = rows.join(mixed_keys, (F.col("key") == F.col("of")) & (F.col("component") != F.col("main")) & _room(
        F.col("room"), F.col("n") + smallest, percent)).filter("id <> pivot").select("key", "id", "n", "room", "component")
    strays = materialize(strays, "shingle-strays")
    sizes = strays.groupBy(F.col("key").alias("of")).agg(
        F.count(F.lit(1)).alias("strays"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("room").alias("most"))
    others = rows.join(sizes, (F.col("key") == F.col("of")) & _room(F.least("room", "most"), F.col("n") + F.col("low"), percent)
                       & (100 * F.col("n") >= percent * F.col("low")) & (percent * F.col("n") <= 100 * F.col("high")))
    others = materialize(others.filter("id <> pivot").select("key", "id", "n", "room", "component", "strays"), "shingle-open")
    return strays.join(sizes.select(F.col("of").alias("key"), "strays"), "key"), others


def _integer_ids(docs: DataFrame, id_col: str) -> None:
    if docs.schema[id_col].dataType.typeName() not in ("long", "integer", "short", "byte"):
        raise TypeError(f"{id_col} must be a whole number: components are named by their smallest id")


def shingle_join(docs: DataFrame, size: int = 5, percent: int = 80, small: int = 64, depth: int = 3,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, links to copies and near copies decided exactly."""
    _integer_ids(docs, id_col)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sets, counts = count_sets(rows, size)
    sketch = docs.sparkSession.sparkContext.broadcast(counts)
    named = rows.filter("doc_id is not null")
    known = sets.filter("doc_id is not null and n_shingles > 0")
    # written first, so that the join of a very large group of copies has two plain exchanges and can be split
    copies = materialize(known.groupBy("sig1", "sig2", "n_shingles").agg(
        F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows"), "shingle-copies")
    edges = materialize(known.join(copies, ["sig1", "sig2", "n_shingles"])
                        .select(F.col("doc_id").alias("a"), "b").filter("a <> b").distinct(), "shingle-edges")
    buckets = materialize(shared_buckets(index_prefixes(named, sketch, size, percent)), "shingle-buckets")
    found: DataFrame | None = None
    for k in range(1, depth + 1):
        star = buckets.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        near = compare(star, known, named, size, percent)
        if found is None or not near.isEmpty():
            edges = edges.unionByName(near)
            found = components(edges)
        strays, others = _open_buckets(buckets.join(found, "id", "left").withColumn(
            "component", F.coalesce("component", "id")), percent)
        few = F.lit(True) if k == depth else F.col("strays") <= small

        def meet(left: DataFrame, right: DataFrame, fits) -> DataFrame:
            return left.join(right.select(*[F.col(c).alias(f"y_{c}") for c in others.columns]), (
                F.col("key") == F.col("y_key")) & (F.col("component") != F.col("y_component")) & fits)

        total = F.col("n") + F.col("y_n")
        met = meet(strays.filter(few), others, _room(F.least("room", "y_room"), total, percent))
        if k < depth:
            # sets that may link by k tokens or fewer have no combination of k + 1 to meet in
            tiny = ~few & _room(F.lit(k), F.col("n") + 1, percent)
            met = met.unionByName(meet(strays.filter(tiny), others.filter(tiny), _room(F.lit(k), total, percent)))
        cross = met.select(F.least("id", "y_id").alias("a"), F.greatest("id", "y_id").alias("b")).distinct()
        more = compare(cross, known, named, size, percent)
        if not more.isEmpty():
            edges = edges.unionByName(more)
            found = components(edges)
        large = strays.filter(~few).select("key", "id").unionAll(others.filter(~few).select("key", "id")).distinct()
        if k == depth or large.isEmpty():
            break
        members = materialize(large.groupBy("id").agg(F.collect_list("key").alias("keys")), "shingle-members")
        buckets = materialize(shared_buckets(_deeper(members, named, sketch, size, percent, k)), "shingle-buckets")
    labels = found.select(F.col("id").alias("of"), F.col("component").alias("label"))
    return (sets.join(labels, F.col("doc_id") == F.col("of"), "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns.

    Rows without an id or without words stay.
    """
    first = (shingle_join(docs, size, percent, id_col=id_col, text_col=text_col)
             .filter("component_id = doc_id").select(F.col("doc_id").alias("kept_id")).distinct())
    rows = docs.join(first, docs[id_col] == first["kept_id"], "left_semi")
    return rows.unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
