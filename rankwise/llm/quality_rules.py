"""Quality rules on repetition, by suffix arrays with longest-common-prefix intervals.

The words of a document are numbered; its suffixes are sorted by prefix
doubling (many documents at once, the document being the first key, so
matches never cross documents).  The longest common prefix of neighbours in
suffix order gives, for every place, the deepest LCP interval it lies in:
the longest substring that starts there and occurs again.  Shallower
intervals and repeats that could be extended to the left lie inside the span
of a deeper or earlier one, so the union of these spans is the union of all
maximal repeated substrings.  A document passes when repeats of at least
``min_words`` words cover at most ``max_covered`` of its words and its
longest repeat has at most ``max_longest`` words.

Both limits lie below what the base rules imply.  Words of a repeat are also
words of a repeated 3-word window, so a covered fraction of a half or more
would never decide.  All places of a repeat count as covered: at a fifth, a
tenth of the text or more is said again.  A passage of more than 50 words,
long enough to be a document of its own, may not occur twice however long
the text is.

Documents are independent: one pass without a shuffle, in blocks of bounded
size, so neither a hot source nor copies matter.

Defined cases: a null text has no words; such a document, like any of fewer
than 50 words, fails the base rules.  Repeated rows give repeated results;
extra columns are not carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankwise.llm.blocks import IS_SPACE, blocks, counts_by_row, covered
from rankwise.llm.tables import pick

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

MIN_WORDS, MAX_BASE_REPEAT_PERCENT, BASE_WINDOW = 50, 50, 3


def suffix_matches(ids: np.ndarray, row_of: np.ndarray) -> np.ndarray:
    """For every place, the length of the longest repeat that starts there.

    ``ids`` numbers the words, ``row_of`` the documents (non-decreasing).
    """
    n = len(ids)
    longest = np.zeros(n, dtype=np.int64)
    if n < 2:
        return longest
    row_end = np.searchsorted(row_of, row_of, side="right")
    _, rank = np.unique(row_of.astype(np.int64) * (int(ids.max()) + 1) + ids, return_inverse=True)
    # rank: the number of suffixes before the group of a suffix, at each depth
    sizes = np.bincount(rank)
    rank = (np.cumsum(sizes) - sizes)[rank]
    order = np.argsort(rank, kind="stable")
    ranks, depth = [rank], 1
    while True:
        same = rank[order[1:]] == rank[order[:-1]]
        shared = np.zeros(n, dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        spots = np.flatnonzero(shared)      # only tied suffixes are sorted again
        if not len(spots):
            break
        places = order[spots]
        further = places + depth
        inside = further < row_end[places]
        second = np.where(inside, rank[np.minimum(further, n - 1)] + 1, 0)
        first = rank[places]
        by = np.lexsort((second, first))
        places, first, second = places[by], first[by], second[by]
        order[spots] = places
        new = np.ones(len(places), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank = rank.copy()
        rank[places] = spots[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        ranks.append(rank)
        depth *= 2
    # LCP of neighbours in suffix order: equal ranks at depth d are d equal words
    left, right = order[:-1], order[1:]
    near = np.flatnonzero(row_of[left] == row_of[right])
    left, right = left[near], right[near]
    a, b = left.copy(), right.copy()
    # two suffixes tied at a depth that runs past the row's end share only what is inside
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        fits = (a + step <= row_end[left]) & (b + step <= row_end[right])
        equal = fits.copy()
        equal[fits] = ranks[level][a[fits]] == ranks[level][b[fits]]
        a[equal] += step
        b[equal] += step
    lcp = a - left
    np.maximum.at(longest, left, lcp)
    np.maximum.at(longest, right, lcp)
    return longest


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    """The counts of every row of a block."""
    n = len(offsets) - 1
    n_words, n_dup_lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids: list[int] = []
    for row in range(n):
        text = data[offsets[row]:offsets[row + 1]].tobytes()
        words = text.split()    # of bytes: at [\x20\x09-\x0D] only
        n_words[row] = len(words)
        ids += map(number.__getitem__, words)
        lines = [line for line in text.split(b"\n") if line.strip()]
        n_dup_lines[row] = len(lines) - len(set(lines))
    row_of = np.repeat(np.arange(n), n_words)
    longest = suffix_matches(np.array(ids, dtype=np.int64), row_of)
    total, first = len(ids), np.cumsum(n_words) - n_words

    def by_row(flags: np.ndarray) -> np.ndarray:
        return counts_by_row(flags, np.append(first, total))

    window = np.flatnonzero(longest >= BASE_WINDOW)
    repeat = np.flatnonzero(longest >= min_words)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row_of, longest)
    starts_char = (data & 0xC0) != 0x80     # UTF-8: not a continuation byte
    return {"n_words": n_words, "word_chars": counts_by_row(starts_char & ~IS_SPACE[data], offsets),
            "n_symbols": counts_by_row(_SYMBOL[data], offsets), "n_dup_lines": n_dup_lines,
            "n_repeat_words": by_row(covered(window, np.full(len(window), BASE_WINDOW), total)),
            "n_covered_words": by_row(covered(repeat, longest[repeat], total)), "longest_repeat": top}


def quality_rules(docs: DataFrame, min_words: int = 8, max_covered: float = 0.2, max_longest: int = MIN_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept: one row per input row."""
    slim = pick(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id")
            for row, stop, data, offsets in blocks(batch.column("text")):
                m = measure(data, offsets, min_words)
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_BASE_REPEAT_PERCENT * m["n_words"])
                kept = ~failed & (m["n_covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(row, stop - row), *[pa.array(m[c]) for c in names], pa.array(failed), pa.array(kept)],
                    ["doc_id", *names, "base_failed", "kept"])

    return slim.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names)
                           + ", base_failed boolean, kept boolean")
