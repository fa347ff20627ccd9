"""Suffix-array dedup of repeated byte strings of at least ``length`` bytes.

A suffix array truncated at ``length`` bytes is built over every part of the
corpus that can hold a repeat, and of the longest-previous-factor array only
the question is asked that matters: is it at least ``length``?  In suffix
order with ties by place, the entries that share their first ``length`` bytes
form a run sorted by place.  The previous smaller place of an entry is the
one before it in the run and the next smaller one lies outside, so an entry
has an earlier match of that length exactly when it is not the first of its
run (and a later one when it is not the last).  ``keep="first"`` removes the
bytes of entries with an earlier match; ``keep="none"`` those with any other
match.  All strings are judged on the input.

The corpus is cut so that equal strings meet without a global sort:

1. Every window of ``length`` bytes has an anchor: its ``gram``-byte substring
   of least hash (the leftmost).  Equal windows have equal anchors.  A run of
   windows with one anchor occurrence is a segment; consecutive segments
   overlap, so every window lies in exactly one.  Only hashes are shuffled.
2. Anchors that occur once cannot hold a repeat and go.  Segments of equal
   content are one segment with a count; if an anchor has only one, all its
   windows are repeats, and no text is compared.
3. The distinct segments of the other anchors fetch their bytes (one per
   distinct segment, however many copies there are) and are grouped by
   anchor; suffixes are sorted by prefix doubling, many groups at once.
4. The spans of a document meet the document, and the bytes go.

A third of all rows in copies are a few counted segments.  An anchor with
more than ``max_group`` distinct segments (a passage in very many different
surroundings) does not go to one task: its windows are compared by a 128-bit
hash each, grouped by that hash with a map-side sum.

Defined cases: a null text is empty; shorter texts lose nothing.  Null ids
come after all others.  Rows with the same id and text are copies of each
other for ``keep="none"``, and one document for ``keep="first"``.  A very
long text is cut into chunks that share their windows.  An empty table gives
an empty result; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.blocks import blocks, covered
from rankwise.llm.hashing import gram_hashes, prefix_sums
from rankwise.llm.tables import pick

#: columns that name a row
KEY = ["unnamed", "id", "dk"]
#: bytes of windows looked at together; places in a chunk fit the low bits of a key
_PLACE_BITS = 21
_CHUNK = (1 << _PLACE_BITS) - 1
_LOW = np.uint64((1 << _PLACE_BITS) - 1)


def segments(data: np.ndarray, length: int, gram: int, valid: np.ndarray | None = None):
    """(first window, windows, anchor's place in the segment, anchor) of each segment.

    ``valid`` says which windows count (those inside one row).
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    hashes = gram_hashes(prefix_sums(data), gram)
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    width, span = 1, length - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:-(span - width)], least[span - width:])
    place = (least & _LOW).astype(np.int64)
    ok = np.ones(len(place), dtype=bool) if valid is None else valid[:len(place)]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (ok[1:] != ok[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    first, count = first[ok[first]], count[ok[first]]
    return first, count, place[first] - first, hashes[place[first]].view(np.int64)


def _segment_rows(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """anchor, seg, KEY, start, n, off of every segment of a batch of (KEY, text)."""
    for row, stop, data, offsets in blocks(batch.column("text"), _CHUNK // 2):
        for c0 in range(0, max(1, len(data) - length + 1), _CHUNK - length):
            # a longer single row is looked at in chunks that overlap by a window
            part = data[c0:c0 + _CHUNK]
            valid = np.zeros(len(part), dtype=bool)
            for a, b in zip(offsets[:-1] - c0, offsets[1:] - c0 - length + 1):
                if b > 0 and b > a:
                    valid[max(a, 0):b] = True
            if c0 + _CHUNK <= len(data):
                valid[_CHUNK - length:] = False     # these windows are the next chunk's
            first, count, off, anchor = segments(part, length, gram, valid)
            if not len(first):
                continue
            view = memoryview(np.ascontiguousarray(part))
            ends = first + count - 1 + length
            seg = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist())],
                           dtype=np.uint64).view(np.int64)
            owner = np.searchsorted(offsets, first + c0, side="right") - 1
            rows = pa.array(owner + row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(seg), *[batch.column(c).take(rows) for c in KEY],
                 pa.array(first + c0 - offsets[owner]), pa.array(count.astype(np.int32)), pa.array(off.astype(np.int32))],
                ["anchor", "seg", *KEY, "start", "n", "off"])


def matched(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the windows (ascending places in ``data``) have an earlier, and which any other match."""
    depth = 8 if length >= 8 else 1
    n = len(data)
    if depth == 8:
        rank = np.zeros(n - 7, dtype=np.uint64)
        for j in range(8):
            rank = (rank << np.uint64(8)) | data[j:n - 7 + j]
    else:
        rank = data.astype(np.uint64)
    rank = np.unique(rank, return_inverse=True)[1]
    while 2 * depth <= length:
        rank = np.unique(rank[:-depth] * (n + 1) + rank[depth:], return_inverse=True)[1]
        depth *= 2
    key = rank[starts]
    if depth < length:
        key = key * (n + 1) + rank[starts + length - depth]
    order = np.argsort(key, kind="stable")      # the truncated suffix array, ties by place
    tied = key[order[1:]] == key[order[:-1]]
    earlier, other = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
    earlier[order[1:]] = tied
    other[order[1:]] = tied
    other[order[:-1]] |= tied
    return earlier, other


def _runs(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of set flags within a group."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) > 1) | (group[at[1:]] != group[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def _match_groups(length: int, keep: str, block_bytes: int):
    """Task body over rows (anchor, KEY, start, n, copies, bytes) sorted by anchor, KEY, start."""
    def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            upto = np.append(0, np.cumsum(batch.column("n").to_numpy().astype(np.int64) + length - 1))
            if held and size >= block_bytes and held[-1].column("anchor")[-1].as_py() != anchors[0]:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            begin = 0
            for end in np.flatnonzero(anchors[1:] != anchors[:-1]) + 1:
                if size + upto[end] - upto[begin] >= block_bytes:
                    yield pa.Table.from_batches([*held, batch.slice(begin, end - begin)])
                    held, size, begin = [], 0, end
            held.append(batch.slice(begin))     # its last group may go on in the next batch
            size += upto[-1] - upto[begin]
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(b for b in batches if b.num_rows):
            table = table.combine_chunks()
            n, copies = table.column("n").to_numpy().astype(np.int64), table.column("copies").to_numpy()
            raw = b"".join(table.column("bytes").to_pylist())
            data = np.frombuffer(raw, dtype=np.uint8)
            sizes = n + length - 1
            base = np.cumsum(sizes) - sizes
            group = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            earlier, other = matched(data, base[group] + within, length)
            # copies of a segment were counted before: their windows need no answer here
            flags = earlier if keep == "first" else other & (copies[group] == 1)
            first, count = _runs(flags, group)
            owner = group[first]
            rows = pa.array(owner)
            begin = table.column("start").to_numpy()[owner] + within[first]
            yield pa.RecordBatch.from_arrays(
                [*[table.column(c).combine_chunks().take(rows) for c in KEY],
                 pa.array(begin), pa.array(count.astype(np.int32))], [*KEY, "start", "n"])

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, KEY (never null), text (never null).

    A row is known by its id and a 64-bit hash of its text; rows without an
    id, which may be very many, by two such hashes, and come after all others.
    """
    slim = pick(docs, doc_id=id_col, text=text_col)
    whole = slim.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    kind = "bigint" if whole else "string"
    unnamed = F.col("doc_id").isNull()
    return slim.withColumn("text", F.coalesce("text", F.lit(""))).select(
        "doc_id", unnamed.alias("unnamed"),
        F.when(unnamed, F.xxhash64(F.lit(1), "text").cast(kind)).otherwise(F.col("doc_id").cast(kind)).alias("id"),
        F.xxhash64("text").alias("dk"), "text")


def spans(rows: DataFrame, length: int, gram: int, keep: str, max_group: int, block_bytes: int = 4 << 20) -> DataFrame:
    """KEY, start, n: the runs of n windows from start on that are to go."""
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _segment_rows(batch, length, gram)

    known = f"unnamed boolean, id {kind}, dk long"
    found = rows.select(*KEY, "text").mapInArrow(cut, f"anchor long, seg long, {known}, start long, n int, off int")
    # written first, so that the join of a hot anchor has two plain exchanges and can be split
    repeated = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("all"), F.min("seg").alias("lo"), F.max("seg").alias("hi"))
                .filter("all >= 2").select("anchor", (F.col("lo") != F.col("hi")).alias("varied")), "suffix-anchors")
    shared = materialize(found.join(repeated.hint("merge"), "anchor"), "suffix-segments")
    place = F.struct(*KEY, "start", "n", "off")
    distinct = materialize(shared.groupBy("anchor", "seg", "varied").agg(F.count(F.lit(1)).alias("copies"),
                                                                        F.min(place).alias("rep")), "suffix-distinct")
    # windows of segments that are copies of each other
    copied = shared.join(distinct.filter("copies > 1").select("anchor", "seg", "rep"), ["anchor", "seg"])
    if keep == "first":
        copied = copied.filter(place != F.col("rep"))
    copied = copied.select(*KEY, "start", "n")
    # the bytes of the distinct segments of varied anchors, fetched once per document
    varied = distinct.filter("varied").select("anchor", "copies", "rep.*")
    crowd = materialize(varied.groupBy("anchor").agg(F.count(F.lit(1)).alias("group")).filter(F.col("group") > max_group),
                        "suffix-crowds")
    wanted = (varied.join(crowd.withColumn("crowded", F.lit(True)), "anchor", "left")
              .groupBy(*KEY).agg(F.collect_list(F.struct(
                  "anchor", "start", "n", F.col("copies").cast("long").alias("copies"),
                  F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("parts")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "start", "n", "copies", "crowded"]
        for batch in batches:
            ids, columns, raw = [], {c: [] for c in names}, []
            for i, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist())):
                text = text.encode()
                for part in parts:
                    ids.append(i)
                    for c in names:
                        columns[c].append(part[c])
                    raw.append(text[part["start"]:part["start"] + part["n"] - 1 + length])
            rows_ = pa.array(ids, pa.int64())
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows_) for c in KEY],
                 *[pa.array(columns[c], t) for c, t in zip(names, types)], pa.array(raw, pa.binary())],
                [*KEY, *names, "bytes"])

    texts = rows.select(*KEY, "text").join(wanted, KEY).select(*KEY, "text", "parts").mapInArrow(
        fetch, f"{known}, anchor long, start long, n int, copies long, crowded boolean, bytes binary")
    out = f"{known}, start long, n int"
    if crowd.isEmpty():
        plain, compared = texts, None
    else:
        texts = materialize(texts.dropDuplicates([*KEY, "start", "n"]), "suffix-texts")
        plain = texts.filter("not crowded")
        compared = _by_hash(texts.filter("crowded"), length, keep, known)
    grouped = (plain.select("anchor", *KEY, "start", "n", "copies", "bytes")
               .dropDuplicates(["anchor", *KEY, "start"])     # rows of one id and text come twice
               .repartition("anchor").sortWithinPartitions("anchor", *KEY, "start")
               .mapInArrow(_match_groups(length, keep, block_bytes), out))
    result = copied.unionByName(grouped)
    return result.unionByName(compared) if compared is not None else result


def _by_hash(texts: DataFrame, length: int, keep: str, known: str) -> DataFrame:
    """The same answer for crowded anchors: one 128-bit hash per window, summed by hash."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, n = batch.column("bytes")[i].as_py(), batch.column("n")[i].as_py()
                at = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(at) for c in KEY], batch.column("copies").take(at),
                     pa.array(batch.column("start")[i].as_py() + np.arange(n)),
                     pa.array([xxhash.xxh3_128_digest(raw[k:k + length]) for k in range(n)], pa.binary())],
                    [*KEY, "copies", "start", "h"])

    windows = texts.select(*KEY, "start", "n", "copies", "bytes").mapInArrow(
        hashed, f"{known}, copies long, start long, h binary")
    place = F.struct(*KEY, "start")
    counts = (windows.groupBy("h").agg(F.count(F.lit(1)).alias("entries"), F.min(place).alias("rep"))
              .filter("entries > 1"))
    hits = windows.join(counts, "h").filter(place != F.col("rep") if keep == "first" else F.col("copies") == 1)
    return hits.select(*KEY, "start", F.lit(1).alias("n"))


def suffix_dedup(docs: DataFrame, length: int = 200, gram: int = 32, keep: str = "first", max_group: int = 20_000,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes): one row per input row."""
    rows = keyed(docs, id_col, text_col)
    gone = spans(rows, length, min(gram, length), keep, max_group).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "n")).alias("gone"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for text, gone_ in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                text = text.encode()
                sizes.append(len(text))
                if not gone_:
                    removed.append(0), runs.append(0), kept.append(text)
                    continue
                starts = np.array([g["start"] for g in gone_], dtype=np.int64)
                counts = np.array([g["n"] for g in gone_], dtype=np.int64)
                out = covered(starts, counts + length - 1, len(text))
                removed.append(int(out.sum()))
                runs.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                kept.append(np.frombuffer(text, dtype=np.uint8)[~out].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    # the id itself is found again from its key, so that the text's exchange is the one used above
    joined = rows.select(*KEY, "text").join(gone, KEY, "left")
    return joined.select(F.when(~F.col("unnamed"), F.col("id")).cast(types["doc_id"]).alias("doc_id"), "text", "gone").mapInArrow(
        strip, f"doc_id {types['doc_id']}, n_bytes long, n_removed long, n_spans long, kept binary")
