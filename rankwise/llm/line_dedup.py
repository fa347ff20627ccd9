"""Line dedup: a segment-partition edit join over lines, in built-in SQL functions.

A line of at least ``min_chars`` characters goes when the same line, or one
within ``edits`` single-character edits, occurs earlier (by document id, then
line number); lines are judged on the input.  Shorter and blank lines stay.

1. Equal lines fall together under a 128-bit hash, map side first; of each
   distinct line only its first place, its length and its index keys travel.
2. A line cut into ``edits`` + 1 segments shares at least one whole segment
   with any line within ``edits`` edits.  The keys of a line are (length,
   segment number, segment); a longer or equally long line probes, for each
   length it can match, the substrings at the places a shared segment can
   have moved to (between the edits possible before and after it).
3. Keys only one line has go.  Members of a key with up to ``bucket`` rows
   meet by a self join.
4. Larger keys are segments of very many variants of a line.  For one edit
   their lines are indexed anew by everything outside one of ``windows``
   windows of the line: the edit falls into one of them, so a similar pair
   still meets, and variants that differ elsewhere do not.  Lines of a crowded
   window are keyed once more by the window less one character, for each of
   its characters: that leaves similar pairs and few others.  For k edits they
   are cut into k + 2 segments, of which a similar pair shares two, and where
   that key is crowded too, into k + 4, of which it shares four; only lines
   that agree in those as well meet in pairs.
5. Pairs are verified by bit-parallel edit distance in a band of 2 * edits + 1
   diagonals, after their common prefix, stopping once the band's diagonal
   score passes ``edits``.

Index tables carry a line as one number.  Where rows of a large table are
wanted by key, a bit table (at most ``FILTER_WORDS`` rows, the bound of its
broadcast) drops most others before the shuffle: only documents with a line to
compare, and at the end only those that lose a line, send their text anywhere.
The joins behind it are exact and of one kind at every size, so a full bit
table costs shuffle, never results.

Defined cases: a null text has one empty line.  Null ids come after all
others.  Rows with the same id and text are one document: their lines are not
copies of each other.  A document is known by 128 bits of its id and text, so
null ids and repeated ids are told apart.  Very long texts and lines are split
and compared whole.  An empty table gives an empty result; extra columns are
not carried.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.tables import pick

#: rows of a bit table, 64 bits each
FILTER_WORDS = 1 << 18
#: segments that crowded lines must share, round by round, when there is more than one edit
SHARED = (2, 4)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _segment(length: Column, i: int | Column, edits: int) -> tuple[Column, Column]:
    """0-based start and length of segment i of a line; the last segments take the remainder."""
    parts = edits + 1
    short = F.floor(length / parts).cast("int")
    long_ones = length % parts
    first_long = F.lit(parts) - long_ones
    start = short * i + F.greatest(F.lit(0), F.lit(i) - first_long)
    return start, short + (F.lit(i) >= first_long).cast("int")


def own_keys(text: Column, edits: int) -> list[Column]:
    length = F.length(text)
    out = []
    for i in range(edits + 1):
        start, size = _segment(length, i, edits)
        out.append(F.xxhash64(length, F.lit(i), F.substring(text, start + 1, size)))
    return out


def probe_keys(text: Column, edits: int) -> list[Column]:
    """Keys of shorter or equally long lines that can share a segment; equal places of equal lengths are own keys."""
    out = []
    for shorter in range(edits + 1):
        length = F.length(text) - shorter
        for i in range(edits + 1):
            start, size = _segment(length, i, edits)
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for move in range(low, high + 1):
                if (shorter, move) != (0, 0):
                    key = F.xxhash64(length, F.lit(i), F.substring(text, start + 1 + move, size))
                    out.append(F.when((start + move >= 0) & (start + move + size <= F.length(text)), key))
    return out


def window_keys(text: Column, windows: int, shorter: int) -> list[Column]:
    """For each window, a hash of what is outside it, in a line ``shorter`` characters shorter."""
    length = F.length(text) - shorter
    out = []
    for w in range(windows):
        before, after = _window(length, windows, w)
        out.append(F.xxhash64(length, F.lit(w), F.substring(text, F.lit(1), before),
                              F.substring(text, F.length(text) - after + 1, after)))
    return out


def _window(length: Column, windows: int, w: int | Column) -> tuple[Column, Column]:
    """The characters before and after window w of a line."""
    return (F.floor(length * w / windows).cast("int"),
            (length - F.floor(length * (w + 1) / windows)).cast("int"))


def deletion_keys(text: Column, windows: int, key: Column, w: Column, own: Column) -> Column:
    """(key, own) within a crowded window: equal lengths share the window less a character at one place,
    and a line (own) is what a longer one leaves (not own)."""
    length = F.length(text) - F.when(own, 0).otherwise(1)
    before, after = _window(length, windows, w)
    size = F.length(text) - before - after
    inside = F.substring(text, before + 1, size)
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))

    def less(p: Column) -> Column:
        rest = F.concat(F.substring(inside, F.lit(1), p), F.substring(inside, p + 2, size))
        return F.struct(F.xxhash64(key, own.cast("int"), rest).alias("key"), own.alias("own"))

    whole = F.struct(F.xxhash64(key, F.lit(0), inside).alias("key"), F.lit(True).alias("own"))
    return F.array_union(F.transform(places, less), F.when(own, F.array(whole)).otherwise(F.array().cast("array<struct<key: bigint, own: boolean>>")))


def _moves(chosen: tuple[int, ...], parts: int, edits: int, shorter: int) -> list[list[int]]:
    """How far the chosen segments of a line can have moved in one that is ``shorter`` characters longer.

    An inserted character counts to the segment before it, so a move changes
    only across segments that are not chosen.
    """
    ways = [([], 0)]    # moves so far, edits they need
    for k, i in enumerate(chosen):
        free = i > (chosen[k - 1] + 1 if k else 0)
        ways = [([*path, m], used + abs(m - (path[-1] if path else 0))) for path, used in ways
                for m in range(-edits, edits + 1)
                if (free or m == (path[-1] if path else 0)) and used + abs(m - (path[-1] if path else 0)) <= edits]
    return [path for path, used in ways
            if path[-1] == shorter or (chosen[-1] < parts - 1 and used + abs(shorter - path[-1]) <= edits)]


def combination_keys(text: Column, edits: int, shared: int) -> Column:
    """(key, own) for every choice of ``shared`` among edits + shared segments, which lines within ``edits`` share."""
    parts = edits + shared
    choices = [{"choice": c, "shorter": s, "own": s == 0 and not any(moves),
                "pieces": [{"i": i, "move": m} for i, m in zip(chosen, moves)]}
               for c, chosen in enumerate(combinations(range(parts), shared))
               for s in range(edits + 1) for moves in _moves(chosen, parts, edits, s)]
    table = F.from_json(F.lit(json.dumps(choices)), "array<struct<choice: int, shorter: int, own: boolean, "
                        "pieces: array<struct<i: int, move: int>>>>")

    def key(choice: Column) -> Column:
        length = F.length(text) - choice["shorter"]

        def piece(part: Column) -> Column:
            start, size = _segment(length, part["i"], parts - 1)
            at = (start + part["move"]).cast("int")
            return F.when((at >= 0) & (at + size <= F.length(text)), F.substring(text, at + 1, size))

        pieces = F.transform(choice["pieces"], piece)
        whole = (length >= 0) & ~F.exists(pieces, lambda x: x.isNull())
        return F.struct(F.when(whole, F.xxhash64(length, choice["choice"], F.array_join(pieces, ""))).alias("key"),
                        choice["own"].alias("own"))

    return F.transform(table, key)


def common_prefix(a: Column, b: Column, limit: Column) -> Column:
    """Characters the two texts share from the start, by doubling and halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])

    def widen(n: Column, step: Column) -> Column:
        fits = (n + step <= limit) & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step))
        return F.when(fits, n + step).otherwise(n)

    # steps above the length cost one comparison of numbers each
    return F.aggregate(steps, F.lit(0), widen)


def edit_distance(short: Column, long: Column, edits: int) -> Column:
    """Edit distance, or any number above ``edits`` if it is larger.

    ``short`` has at most as many characters as ``long``.  A column of the
    matrix is a band of 2 * edits + 1 cells around the diagonal, its vertical
    differences two bit vectors; the score follows the diagonal that ends in
    the last cell, and never falls, so a pair above ``edits`` stops there.
    """
    band = 2 * edits + 1
    mask = F.lit((1 << band) - 1).cast("bigint")
    pattern, text = F.split(short, ""), F.split(long, "")
    m, n = F.length(short), F.length(long)
    zero = F.lit(0).cast("bigint")

    def flip(x: Column) -> Column:
        return x.bitwiseXOR(mask)

    def step(state: Column, j: Column) -> Column:
        # bit i of the band is row j - edits + i of the matrix
        def row_bit(i: int) -> Column:
            row = j - edits + i
            same = (row >= 1) & (row <= m) & (F.get(pattern, row - 1) == F.get(text, j - 1))
            return F.when(same, F.lit(1 << i).cast("bigint")).otherwise(zero)

        equal = row_bit(0)
        for i in range(1, band):
            equal = equal + row_bit(i)

        def advance(eq: Column) -> Column:
            vp, vn = state["vp"], state["vn"]
            sums = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(mask)

            def close(d0: Column) -> Column:
                hp = vn.bitwiseOR(flip(d0.bitwiseOR(vp)))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                on_diagonal = F.floor(d0 / F.pow(F.lit(2.0), F.lit(edits) + m - n)).cast("bigint").bitwiseAND(F.lit(1).cast("bigint"))
                more = F.when(j > n - m, F.lit(1) - on_diagonal.cast("int")).otherwise(F.lit(0))
                return F.struct(hn.bitwiseOR(flip(down.bitwiseOR(hp))).alias("vp"), down.bitwiseAND(hp).alias("vn"),
                                (state["score"] + more).alias("score"))

            return _let(sums, close)

        return F.when(state["score"] > edits, state).otherwise(_let(equal, advance))

    start = F.struct(F.lit(((1 << band) - 1) ^ ((1 << edits) - 1)).cast("bigint").alias("vp"), zero.alias("vn"),
                     (n - m).alias("score"))
    columns = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.when(n - m > edits, n - m).otherwise(F.aggregate(columns, start, step)["score"])


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are at most ``edits`` edits apart: common prefix first, then the band."""
    def after_prefix(pair: Column) -> Column:
        rest_a, rest_b = F.substr(a, pair + 1), F.substr(b, pair + 1)
        flipped = F.length(a) <= F.length(b)
        short, long = F.when(flipped, rest_a).otherwise(rest_b), F.when(flipped, rest_b).otherwise(rest_a)
        return _let(F.struct(short.alias("s"), long.alias("l")),
                    lambda x: edit_distance(x["s"], x["l"], edits) <= edits)

    return _let(common_prefix(a, b, F.least(F.length(a), F.length(b))), after_prefix)


def _spot(key: str) -> tuple[Column, Column]:
    """The row and the bit of a key in a bit table."""
    h = F.xxhash64(key)
    return F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS)), h.bitwiseAND(F.lit(63)).cast("int")


def _marked(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``table`` with ``maybe``: false only where no row of ``wanted`` has the key."""
    spot, bit = _spot(key)
    bits = (wanted.select(spot.alias("spot"), bit.alias("bit"))
            .groupBy("spot").agg(F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), bit)")).alias("word")))
    found = table.withColumns({"spot": spot, "bit": bit}).join(F.broadcast(bits), "spot", "left")
    return found.withColumn("maybe", F.coalesce(F.getbit("word", F.col("bit")) == 1, F.lit(False))).drop("spot", "bit", "word")


def _wanted(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``table`` with the columns of the row of ``wanted`` that has their key (unique there)."""
    return _marked(table, key, wanted).filter("maybe").drop("maybe").join(wanted.hint("merge"), key)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, k (128 bits of id and text), text (never null)."""
    slim = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    return slim.select("doc_id", F.unhex(F.md5(F.concat(F.md5("text"), name))).alias("k"), "text")


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Every line of at least ``min_chars`` characters that is not blank, with its hash."""
    lines = rows.select("doc_id", "k", F.posexplode(F.split("text", "\n")).alias("line", "value"))
    return (lines.filter(F.length("value") >= min_chars).filter(F.col("value").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("h", F.unhex(F.md5("value"))))


def line_dedup(docs: DataFrame, edits: int = 1, min_chars: int = 20, bucket: int = 128, windows: int = 16,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, text (the lines that stay): one row per input row."""
    rows = _rows(docs, id_col, text_col)
    # null ids come last: the flag goes before the id
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k", "line")
    value = F.col("value")
    long_lines = _lines(rows, min_chars)
    first = materialize(
        long_lines.groupBy("h").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(place.alias("place"), F.array(*own_keys(value, edits)).alias("own"),
                           F.array(*probe_keys(value, edits)).alias("probe"))).alias("f"))
        .select(F.monotonically_increasing_id().alias("n"), "h", "copies", "f.*"), "line-first")
    # copies of an earlier line
    repeated = first.filter("copies > 1").select("h", F.col("place.k").alias("first_k"), F.col("place.line").alias("first_line"))
    copies = (_wanted(long_lines.select("h", "k", "line"), "h", repeated)
              .filter("k <> first_k or line <> first_line").select("k", "line"))
    # index and probe rows of the distinct lines
    keys = first.select("n", F.explode(F.concat(
        F.transform("own", lambda k: F.struct(k.alias("key"), F.lit(True).alias("own"))),
        F.transform("probe", lambda k: F.struct(k.alias("key"), F.lit(False).alias("own"))))).alias("k")).select(
        "n", "k.key", "k.own").filter("key is not null")

    def shared(index: DataFrame, name: str) -> DataFrame:
        """The rows of keys that several lines have, one of them as owner, with their number."""
        counts = index.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.count_if("own").alias("owners")).filter(
            "members > 1 and owners > 0")
        return materialize(index.join(counts.select("key", "members").hint("merge"), "key"), name)

    def texts_of(numbers: DataFrame, name: str) -> DataFrame:
        """n, place, value of the distinct lines of the given numbers (unique there)."""
        found = materialize(_wanted(first.select("n", "place"), "n", numbers), f"{name}-places")
        wanted = found.groupBy(F.col("place.k").alias("k")).agg(
            F.collect_list(F.struct("n", F.col("place.line").alias("line"))).alias("lines"))
        wanted = materialize(wanted, f"{name}-documents")
        parts = _wanted(rows.select("doc_id", "k", "text"), "k", wanted).dropDuplicates(["k"])
        split = parts.select("doc_id", "k", F.split("text", "\n").alias("all"), F.explode("lines").alias("at")).select(
            F.col("at.n").alias("n"), "doc_id", "k", F.col("at.line").alias("line"), F.get("all", F.col("at.line")).alias("value"))
        return materialize(split.select("n", place.alias("place"), "value"), name)

    def pairs(table: DataFrame) -> DataFrame:
        """Each owner of a key with the others; two owners once, the lower number as ``a``."""
        left = table.filter("own").select("key", F.col("n").alias("a"))
        right = table.select("key", F.col("n").alias("b"), "own")
        met = left.join(right, "key").filter("(own and a < b) or (not own and a <> b)")
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    members = shared(keys, "line-keys")
    candidates = pairs(members.filter(F.col("members") <= bucket))
    crowd = materialize(members.filter(F.col("members") > bucket).select("n").distinct(), "line-crowds")
    crowded = None if crowd.isEmpty() else texts_of(crowd, "line-crowd-texts").select("n", "value")
    if edits == 1 and crowded is not None:
        def keyed(own: bool) -> Column:
            return F.transform(F.array(*window_keys(value, windows, 0 if own else 1)), lambda k, w: F.struct(
                k.alias("key"), F.lit(own).alias("own"), w.alias("w")))

        anew = shared(crowded.select("n", F.explode(F.concat(keyed(True), keyed(False))).alias("k")).select("n", "k.*"),
                      "line-windows")
        candidates = candidates.unionByName(pairs(anew.filter(F.col("members") <= bucket))).distinct()
        within_window = materialize(anew.filter(F.col("members") > bucket).select(
            "n", F.col("key").alias("window"), "w", F.col("own").alias("is_own")), "line-crowds")
        if not within_window.isEmpty():
            anew = within_window.join(crowded, "n").select("n", F.explode(deletion_keys(
                value, windows, F.col("window"), F.col("w"), F.col("is_own"))).alias("k")).select("n", "k.*")
            candidates = candidates.unionByName(pairs(shared(anew, "line-deletions"))).distinct()
    for count in SHARED if edits > 1 and crowded is not None else ():
        anew = shared(crowded.select("n", F.explode(combination_keys(value, edits, count)).alias("k")).select(
            "n", "k.key", "k.own").filter("key is not null"), "line-segments")
        few = F.lit(True) if count == SHARED[-1] else F.col("members") <= bucket
        candidates = candidates.unionByName(pairs(anew.filter(few))).distinct()
        crowded = crowded.join(anew.filter(~few).select("n").distinct(), "n", "left_semi")
    candidates = materialize(candidates, "line-pairs")
    ends = materialize(candidates.select(F.col("a").alias("n")).unionAll(candidates.select("b")).distinct(), "line-ends")
    texts = texts_of(ends, "line-texts")
    side = lambda c: texts.select(F.col("n").alias(c), F.col("place").alias(f"p{c}"), F.col("value").alias(f"t{c}"))
    near = (candidates.join(side("a"), "a").join(side("b"), "b").filter(within(F.col("ta"), F.col("tb"), edits))
            .select(F.greatest("pa", "pb").alias("late")).select("late.k", "late.line"))
    # a distinct line that goes takes all its places with it: the copies go anyway
    gone = materialize(copies.unionByName(near).groupBy("k").agg(F.collect_set("line").alias("gone")), "line-gone")
    lines = F.split("text", "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i))
    marked = _marked(rows, "k", gone.select("k"))
    whole = marked.filter("not maybe").select("doc_id", "text", F.lit(None).cast("array<int>").alias("gone"))
    cut = marked.filter("maybe").join(gone.hint("merge"), "k", "left").select("doc_id", "text", "gone")
    return whole.unionByName(cut).select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
