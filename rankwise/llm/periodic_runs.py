"""Periodic run detection over the words of a text, by a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least
max(``min_words``, ``min_periods`` * q) words that no neighbouring word
extends keeping that period.

1. Words are numbered.  Factors of 1, 2, 4, ... words get names, equal factors
   of one document equal names, by pairing the names of their halves; only
   factors that occur twice are carried on (a longer one can't occur twice if
   its half doesn't).  Many documents are named at once, the document being
   part of the first name, so matches never cross documents.
2. Per length the places of a name stand in order.  Successors no further
   apart than twice the length form arithmetic progressions: two equal steps
   in a row propose the step as a period.  A run of period q holds, for the
   first length of at least q, occurrences exactly q words apart (a word
   sequence that is as long as the smallest period doesn't recur earlier), so
   every run of four periods or more is proposed.
3. A proposal is extended to both sides by the names themselves, from the
   longest down, as in binary search.  Equal stretches keep their smallest
   step, which is their smallest period.

Documents are independent: one pass without a shuffle, in blocks of bounded
size, so neither a hot source nor copies matter.

Defined cases: a null text has no words, no runs and an empty collapsed text.
A text without a run keeps every word.  A null id counts as an empty text
where a value is derived from it.  Repeated rows give repeated results, an
empty table an empty one; extra columns are not carried.  A text longer than
a block is a block of its own: memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankwise.llm.blocks import blocks, covered
from rankwise.llm.tables import pick

_FIELDS = {"doc_id": None, "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
           "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}


def basic_factors(ids: np.ndarray, row_of: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i]: the name of the 2^k words from i on, -1 where they occur once or leave the document."""
    n = len(ids)
    key = row_of.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    names, places, k = [], np.arange(n), 0
    while len(places):
        _, name, size = np.unique(key, return_inverse=True, return_counts=True)
        twice = size[name] > 1
        places, name = places[twice], name[twice]
        level = np.full(n, -1, dtype=np.int64)
        level[places] = name
        names.append(level)
        step = 1 << k
        if 2 * step > longest:
            break
        # both halves are known to occur twice; the second lies in the same document, as its name says
        inside = places + step < n
        places = places[inside]
        second = level[places + step]
        both = (second >= 0) & (row_of[places] == row_of[np.minimum(places + step, n - 1)])
        places, second = places[both], second[both]
        key = level[places] * (int(level.max(initial=0)) + 1) + second
        k += 1
    return names


def proposals(names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, step) of successors that go on with the same step."""
    places, steps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, level in enumerate(names):
        at = np.flatnonzero(level >= 0)
        at = at[np.argsort(level[at], kind="stable")]
        gap = np.diff(at)
        near = (level[at[1:]] == level[at[:-1]]) & (gap <= 2 << k)
        again = np.flatnonzero(near[1:] & near[:-1] & (gap[1:] == gap[:-1]))
        places.append(at[again])
        steps.append(gap[again])
    place, step = np.concatenate(places), np.concatenate(steps)
    # neighbouring places with one step lie in one run: its first place stands for them
    by = np.lexsort((place, step))
    place, step = place[by], step[by]
    first = np.ones(len(place), dtype=bool)
    first[1:] = (step[1:] != step[:-1]) | (place[1:] - place[:-1] > 1)
    return place[first], step[first]


def extended(names: list[np.ndarray], place: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the longest stretch around each place in which words ``step`` apart are equal."""
    n = len(names[0]) if names else 0
    low, high = place.copy(), place.copy()
    # to the right and to the left by the longest factor as often as it fits (a run may be longer than any),
    # then once by each shorter one
    for k in range(len(names) - 1, -1, -1):
        level, size, todo = names[k], 1 << k, np.arange(len(place))
        while len(todo):
            a, b = high[todo], high[todo] + step[todo]
            ok = b < n
            ok[ok] = (level[a[ok]] >= 0) & (level[a[ok]] == level[b[ok]])
            todo = todo[ok]
            high[todo] += size
            if k < len(names) - 1:
                break
        todo = np.arange(len(place))
        while len(todo):
            a, b = low[todo] - size, low[todo] - size + step[todo]
            ok = a >= 0
            ok[ok] = (level[a[ok]] >= 0) & (level[a[ok]] == level[b[ok]])
            todo = todo[ok]
            low[todo] -= size
            if k < len(names) - 1:
                break
    return low, high + step - low


def runs(ids: np.ndarray, row_of: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    """(start, length, period) of every run, by start, then period; starts count over all documents."""
    if not len(ids):
        return np.zeros((0, 3), dtype=np.int64)
    longest = int(np.bincount(row_of).max())
    # a period of at most longest / min_periods needs a factor of at least that length
    names = basic_factors(ids, row_of, max(1, 2 * longest // min_periods))
    place, step = proposals(names)
    start, length = extended(names, place, step)
    long_enough = length >= np.maximum(min_words, min_periods * step)
    found = np.unique(np.stack([start, length, step], axis=1)[long_enough], axis=0)
    # equal stretches: the smallest step comes first and is the smallest period
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def looped(words: list, doc_id: object) -> list:
    """The text of one document in ten by its id's checksum, its end replaced by a loop; else the text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a:a + p]
    return words[:a] + (loop * ((n - a) // p + 1))[:n - a]


def _digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def measure(texts: list[list[bytes]], min_words: int, min_periods: int) -> dict[str, list]:
    """The result columns of documents given as lists of words."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    n_words = np.array([len(words) for words in texts], dtype=np.int64)
    ids = np.fromiter((number[w] for words in texts for w in words), np.int64, int(n_words.sum()))
    first = np.cumsum(n_words) - n_words
    row_of = np.repeat(np.arange(len(texts)), n_words)
    found = runs(ids, row_of, min_words, min_periods)
    gone = covered(found[:, 0] + found[:, 2], found[:, 1] - found[:, 2], len(ids))
    cut = np.searchsorted(found[:, 0], np.append(first, len(ids)))
    out: dict[str, list] = {c: [] for c in _FIELDS if c != "doc_id"}
    for row, words in enumerate(texts):
        own = found[cut[row]:cut[row + 1]] - np.array([first[row], 0, 0])
        top: tuple = (None, None, None)
        if len(own):
            at = np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]
            top = tuple(int(v) for v in own[at])
            flags = gone[first[row]:first[row] + len(words)]
            words = [w for w, drop in zip(words, flags.tolist()) if not drop]
        out["n_runs"].append(len(own))
        for name, value in zip(("start", "length", "period"), top):
            out[name].append(value)
        out["exponent_milli"].append(None if top[0] is None else 1000 * top[1] // top[2])
        out["runs_sha256"].append(_digest("".join(f"{s},{n},{p}\n" for s, n, p in own.tolist()).encode()))
        out["collapsed_sha256"].append(_digest(b" ".join(words)))
    return out


def periodic_runs(docs: DataFrame, min_words: int = 6, min_periods: int = 4,
                  rewrite: Callable[[list, object], list] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run and digests of all runs and of the collapsed text: one row per input row.

    ``rewrite(words, doc_id)`` may change the words before they are read.
    """
    if min_periods < 4:
        raise ValueError("a run has at least four periods here")
    slim = pick(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id")
            for row, stop, data, offsets in blocks(batch.column("text")):
                texts = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
                if rewrite:
                    texts = [rewrite(words, i) for words, i in zip(texts, doc_id.slice(row, stop - row).to_pylist())]
                found = measure(texts, min_words, min_periods)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(row, stop - row), *[pa.array(v, _FIELDS[c]) for c, v in found.items()]],
                    list(_FIELDS))

    return slim.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, "
                           "exponent_milli long, runs_sha256 string, collapsed_sha256 string")
