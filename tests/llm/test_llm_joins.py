"""Suffix dedup, line dedup and the shingle join against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from llm_cases import documents, frame, null_last
from pyspark.sql import functions as F

from rankwise.llm import line_dedup, shingle_join, suffix_dedup
from rankwise.llm.components import components


def by_id(rows):
    return sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))


def naive_suffix(rows, length, keep):
    raw = [(t or "").encode() for _, t, _ in rows]
    places = defaultdict(list)
    for i in by_id(rows):
        for p in range(len(raw[i]) - length + 1):
            places[raw[i][p:p + length]].append((i, p))
    gone = [bytearray(len(x)) for x in raw]
    for found in places.values():
        for i, p in found[1 if keep == "first" else 0:] if len(found) > 1 else []:
            gone[i][p:p + length] = b"\1" * length
    return [(rows[i][0], len(raw[i]), sum(g), sum(1 for j, x in enumerate(g) if x and (j == 0 or not g[j - 1])),
             bytes(c for c, x in zip(raw[i], g) if not x).hex()) for i, g in enumerate(gone)]


@pytest.mark.parametrize("keep,length,gram,crowd", [("none", 30, 8, 10 ** 9), ("none", 30, 8, 3), ("first", 40, 40, 10 ** 9),
                                                    ("first", 20, 6, 2)])
def test_suffix_dedup(spark, keep, length, gram, crowd):
    rows = [(i, t[:1500] if t else t, s) for i, t, s in documents(seed=6, n=50)] + [(7001, "xy" * 90, "a")]
    if keep == "first":     # rows of one id and text are one document there
        rows = list(dict.fromkeys(rows))
    out = suffix_dedup.suffix_dedup(frame(spark, rows), length, gram, keep, crowd)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept).hex()) for r in out.collect()]
    assert null_last(got) == null_last(naive_suffix(rows, length, keep))


def test_windows_of_a_long_row_are_each_seen_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 200)
    text = "".join(random.Random(1).choice("ab") for _ in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array([False]), pa.array([1]), pa.array([2]), pa.array([text])],
                                       [*suffix_dedup.KEY, "text"])
    rows = pa.Table.from_batches(list(suffix_dedup._segment_rows(batch, 20, 6))).to_pylist()
    assert sorted(r["start"] + k for r in rows for k in range(r["n"])) == list(range(3000 - 20 + 1))


@pytest.mark.parametrize("n", [199, 200, 201, 379, 380, 381, 560])
def test_windows_of_a_row_that_ends_with_a_chunk_are_each_seen_once(monkeypatch, n):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 200)
    text = "".join(random.Random(n).choice("ab") for _ in range(n))
    batch = pa.RecordBatch.from_arrays([pa.array([False]), pa.array([1]), pa.array([2]), pa.array([text])],
                                       [*suffix_dedup.KEY, "text"])
    rows = pa.Table.from_batches(list(suffix_dedup._segment_rows(batch, 20, 6))).to_pylist()
    assert sorted(r["start"] + k for r in rows for k in range(r["n"])) == list(range(n - 20 + 1))


def edit_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def edited(rnd, text, times):
    chars = list(text)
    for _ in range(times):
        at, how = rnd.randrange(len(chars) + 1), rnd.randrange(3)
        if how == 0:
            chars.insert(at, rnd.choice("abé"))
        elif chars:
            at %= len(chars)
            chars[at:at + 1] = [] if how == 1 else [rnd.choice("abé")]
    return "".join(chars)


def test_banded_distance_equals_the_full_matrix(spark):
    rnd = random.Random(2)
    pairs = []
    for _ in range(250):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randrange(14)))
        pairs.append((a, edited(rnd, a, rnd.randrange(5))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", *[line_dedup.within(F.col("a"), F.col("b"), e).alias(f"w{e}") for e in (1, 3)]).collect():
        assert (r.w1, r.w3) == (edit_distance(r.a, r.b) <= 1, edit_distance(r.a, r.b) <= 3), r


def naive_lines(rows, edits, min_chars):
    first, places = {}, []
    for i in by_id(rows):
        for j, line in enumerate((rows[i][1] or "").split("\n")):
            if len(line) >= min_chars and re.search(r"[^\x20\x09-\x0D]", line):
                places.append((i, j, line))
    for n, (_, _, line) in enumerate(places):
        first.setdefault(line, n)
    distinct = sorted(first, key=first.get)
    near = {b for k, b in enumerate(distinct) for a in distinct[:k]
            if abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits}
    gone = {(i, j) for n, (i, j, line) in enumerate(places) if first[line] != n or line in near}
    out = []
    for i, (d, t, _) in enumerate(rows):
        lines = (t or "").split("\n")
        kept = [x for j, x in enumerate(lines) if (i, j) not in gone]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("edits,bucket", [(1, 128), (1, 3), (2, 128)])
def test_line_dedup(spark, edits, bucket):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.choice([5, 9, 14, 30]))) for _ in range(12)]
    rows = [(i, "\n".join(edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2])) for _ in range(rnd.randrange(5))), "a")
            for i in range(40)]
    rows += [(900, None, None), (901, "", "a"), (None, base[0], "a"), (902, "\n\n" + " " * 30, "a"), (903, base[3] * 40, "a")]
    got = [tuple(r) for r in line_dedup.line_dedup(frame(spark, rows), edits, 8, bucket, 4).collect()]
    assert null_last(got) == null_last(naive_lines(rows, edits, 8))


def texts_of_equal_short_hash(spark, ending):
    """Two texts that a 32-bit hash takes for one."""
    texts = spark.range(300_000).select(F.concat(F.lit("this document has the number "), F.col("id").cast("string"),
                                                 F.lit(ending)).alias("text"))
    found = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).filter("size(texts) > 1").first()
    return found["texts"][:2]


def test_rows_without_id_are_told_apart_by_their_whole_text(spark):
    shared = "a passage that both of the documents have in common, word for word"
    one, two = texts_of_equal_short_hash(spark, "\n" + shared)
    top = (1 << 63) - 1     # an id like any other
    rows = [(None, one, "a"), (None, two, "a"), (top, "the text of the last possible id", "a"), (5, None, "a")]
    got = line_dedup.line_dedup(frame(spark, rows), 1, 20).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 1]
    assert sorted(len(r.text.split("\n")) for r in got if r.doc_id is None) == [1, 2]
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == [5, top]
    for keep in ("first", "none"):
        got = suffix_dedup.suffix_dedup(frame(spark, rows), 40, 8, keep).collect()
        size = len(shared) + (0 if one[-len(shared) - 2] != two[-len(shared) - 2] else 1) + 1
        lost = sorted(r.n_removed for r in got if r.doc_id is None)
        assert (lost[0] == 0) == (keep == "first") and size <= lost[1] < size + 29
        assert {r.doc_id: r.n_removed for r in got if r.doc_id is not None} == {5: 0, top: 0}


def pairs_compared(monkeypatch):
    """How many pairs each later run of line_dedup verifies."""
    told, write = [], line_dedup.materialize

    def noted(table, name):
        out = write(table, name)
        if name == "line-pairs":
            told.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialize", noted)
    return told


@pytest.mark.parametrize("edits", [2, 3])
def test_crowded_segments_are_keyed_anew_for_more_edits(spark, monkeypatch, edits):
    rnd = random.Random(edits)
    lines = ["a common first half of every line" + "".join(rnd.choice("abcdefgh") for _ in range(30)) for _ in range(120)]
    lines += [edited(rnd, rnd.choice(lines), rnd.randrange(1, edits + 2)) for _ in range(40)]
    rows = [(i, x, "a") for i, x in enumerate(lines)]
    told = pairs_compared(monkeypatch)
    got = [tuple(r) for r in line_dedup.line_dedup(frame(spark, rows), edits, 8, 8).collect()]
    assert null_last(got) == null_last(naive_lines(rows, edits, 8))
    assert told[0] < 160 * 159 // 2 // 20


def test_numbered_lines_of_one_window_do_not_meet_in_all_pairs(spark, monkeypatch):
    rnd = random.Random(5)
    numbers = rnd.sample(range(10 ** 5), 150)
    lines = [f"this line has a number at the end, and it is item {n:05}" for n in numbers]
    lines += [x[:-1] for x in lines[:20]] + [x + "7" for x in lines[:20]] + [x[:-3] + "x" + x[-2:] for x in lines[20:40]]
    rnd.shuffle(lines)
    rows = [(i, x, "a") for i, x in enumerate(lines)]
    told = pairs_compared(monkeypatch)
    got = [tuple(r) for r in line_dedup.line_dedup(frame(spark, rows), 1, 20, 8, 4).collect()]
    assert null_last(got) == null_last(naive_lines(rows, 1, 20))
    assert told[0] < len(lines) * (len(lines) - 1) // 2 // 10


@pytest.mark.parametrize("edits,shared", [(1, 2), (2, 2), (2, 4), (3, 2), (4, 3)])
def test_lines_within_the_edits_share_a_combination_of_segments(spark, edits, shared):
    rnd = random.Random(7)
    lines = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(8, 40))) for _ in range(60)]
    pairs = [sorted((x, edited(rnd, x, rnd.randrange(1, edits + 1))), key=len) for x in lines]
    keys = lambda c: line_dedup.combination_keys(F.col(c), edits, shared)
    out = spark.createDataFrame(pairs, "short string, long string").select("short", "long", keys("short").alias("a"), keys("long").alias("b"))
    for r in out.collect():
        assert {k.key for k in r.a if k.own} & {k.key for k in r.b}, (r.short, r.long)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def naive_components(rows, percent=80):
    sets, root = [shingles(t) for _, t, _ in rows], {i: i for i, _, _ in rows if i is not None}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(rows[i][0]), top(rows[j][0])))
                root[b] = a
    return [(i, len(s), top(i) if i is not None else None) for (i, _, _), s in zip(rows, sets)]


@pytest.mark.parametrize("small,depth", [(64, 3), (2, 3)])
def test_shingle_join(spark, small, depth):
    rows = documents(seed=8, n=110) + [(8001, "A b", "a"), (8003, "a  B", "a")]
    out = shingle_join.shingle_join(frame(spark, rows), small=small, depth=depth)
    assert null_last(tuple(r) for r in out.collect()) == null_last(naive_components(rows))


@pytest.mark.parametrize("percent,small", [(30, 1), (50, 1), (50, 64)])
def test_shingle_join_loses_no_link_of_small_sets(spark, percent, small):
    """Sets that link by one common token, in buckets that are open for combinations of more."""
    rnd = random.Random(8)
    rows = [(i, f"a b c d e x{i}", "a") for i in range(1, 101)] + [(500, "a b c d e", "a")]
    rows += [(1000 + i, " ".join(rnd.choice("pq") for _ in range(rnd.randrange(5, 9))) + rnd.choice([" y", " z", f" {i}"]), "a")
             for i in range(70)]
    got = [tuple(r) for r in shingle_join.shingle_join(frame(spark, rows), 5, percent, small).collect()]
    assert null_last(got) == null_last(naive_components(rows, percent))


def test_shingle_join_takes_whole_number_ids_only(spark):
    with pytest.raises(TypeError, match="whole number"):
        shingle_join.shingle_join(spark.createDataFrame([("x", "a b c")], "doc_id string, text string"))
    assert shingle_join.shingle_join(frame(spark, [])).collect() == []


def test_prefix_index_streams_over_batches():
    rnd = random.Random(1)
    rows = sorted({(rnd.randrange(30), rnd.randrange(40)) for _ in range(200)} | {(99, i) for i in range(50)})
    rows = [r for r in rows for _ in range(rnd.choice([1, 1, 2]))]
    body = {}

    class Plan:
        def repartition(self, *_):
            return self

        sortWithinPartitions = repartition

        def mapInArrow(self, f, _):
            body["f"] = f

    shingle_join.shared_buckets(Plan())
    members = defaultdict(set)
    for k, i in rows:
        members[k].add(i)
    want = sorted((k, i, min(m)) for k, m in members.items() if len(m) > 1 for i in m)
    for cut in (1, 2, 7, 1000):
        parts = [pa.RecordBatch.from_pydict({"key": [k for k, _ in rows[a:a + cut]], "id": [i for _, i in rows[a:a + cut]],
                                             "n": [5] * len(rows[a:a + cut]), "pos": [0] * len(rows[a:a + cut])})
                 for a in range(0, len(rows), cut)]
        got = [(r["key"], r["id"], r["pivot"]) for b in body["f"](iter(parts)) for r in b.to_pylist()]
        assert sorted(got) == want


def test_parity_bound_never_fails_a_similar_pair():
    import numpy as np
    rnd = random.Random(7)
    for _ in range(200):
        x = {rnd.getrandbits(64) for _ in range(rnd.choice([1, 5, 60, 700]))}
        y = set(rnd.sample(sorted(x), int(len(x) * rnd.uniform(0.7, 1)))) | {rnd.getrandbits(64) for _ in range(rnd.randrange(5))}
        bits = [np.bitwise_count(a ^ b) for a, b in zip(*(shingle_join.parity(np.array(sorted(s), np.uint64)).view(np.uint64)
                                                       for s in (x, y)))]
        assert sum(int(b) for b in bits) <= len(x ^ y)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(5, k) for k in range(100, 140)] + [(3, 3)]
    rnd = random.Random(2)
    rnd.shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 20 for i in range(20, 61)} | {5: 5} | {k: 5 for k in range(100, 140)}
