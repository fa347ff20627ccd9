"""LM scoring: a gated recurrent language model trained on Spark's partitions.

1. Words of the training documents are counted, map side first.  N, V and the
   counts of every word are exact; the most frequent words (``dictionary`` of
   them at most) go to every task, all others stay in the counts table.
2. Every text becomes a row of 16-bit symbols, written once: one symbol per
   head word (the ``classes`` * ``members`` most frequent), one per class of
   other words (by first and last byte, known for unseen words too).  Words
   outside the dictionary are kept beside them and meet the counts by a join:
   none of them is frequent, so the join has no hot key.
3. The model reads symbols: a gated recurrent unit, an output softmax over
   classes, and within a head class a softmax over its words; a word of
   another class has its share of the class's count plus one, which leaves
   room for an unseen word.  Training runs on all training documents, round
   by round: each task takes the parameters of the round before, learns from
   its rows by truncated backpropagation (lanes of running text, the state
   carried from window to window and cleared at a document's start; the
   gradient is taken in every window), and the tasks'
   parameters are averaged, weighted by their tokens.  Parameters are sums
   over tasks in Spark; the driver gets one set of them, a fixed number.
4. Scoring carries the state through all windows of a document, documents of
   a batch beside each other by length, so the log-likelihood covers the
   whole text.

Defined cases: a null or empty text is its end token alone; a null id counts
as an empty text where the folds are dealt.  Without training documents N and
V are 0 and every token has base probability 1.  Repeated rows are scored
alike, an empty table gives an empty result; extra columns are not carried.
A very long text runs as one lane: memory follows its number of words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.blocks import IS_SPACE, blocks, words_of
from rankwise.llm.tables import pick

END = b""           # no word is empty
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
_FLUSH = 1 << 18    # distinct words a counting task holds; twice as many with those not yet summed
_CHUNK = 1 << 20    # symbols a training task holds
_AVERAGE = 1 << 10  # parameters in a row of the average
_WINDOWS = 1 << 8   # windows a training stream is cut into, at least
_LANES = 1 << 11    # documents scored beside each other
_TOKENS = 1 << 15   # symbols of a scoring window, about
_ROWS = 1 << 12     # rows of a class softmax at a time


def held_out(id_column: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == fold


@dataclass(frozen=True)
class Shape:
    """Fixed sizes of a model; head words number ``classes`` * ``members``."""
    hidden: int = 16
    classes: int = 16
    members: int = 64
    others: int = 32
    window: int = 16
    lanes: int = 256
    rate: float = 0.03

    @property
    def head(self) -> int:
        return self.classes * self.members

    def parts(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {"input": (self.head + self.others, 3 * h), "state": (h, 3 * h),
                "class": (h, self.classes + self.others), "class_bias": (self.classes + self.others,),
                "word": (self.classes, h, self.members), "word_bias": (self.classes, self.members)}

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, size in self.parts().items():
            n = int(np.prod(size))
            out[name] = flat[at:at + n].reshape(size)
            at += n
        return out

    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts().values())


def start(shape: Shape, head_counts: np.ndarray, other_counts: np.ndarray) -> np.ndarray:
    """Parameters that predict the unigram shares of the symbols."""
    rnd = np.random.default_rng(13)
    flat = np.zeros(shape.size(), dtype=np.float32)
    p = shape.views(flat)
    p["input"][:] = rnd.normal(0, 0.3, p["input"].shape)
    p["state"][:] = rnd.normal(0, 1 / np.sqrt(shape.hidden), p["state"].shape)
    counts = np.full(shape.head, 1e-9)
    counts[:len(head_counts)] = head_counts + 1.0
    counts = counts.reshape(shape.classes, shape.members)
    totals = np.append(counts.sum(axis=1), other_counts + 1.0)
    p["class_bias"][:] = np.log(totals / totals.sum())
    p["word_bias"][:] = np.log(counts / counts.sum(axis=1, keepdims=True))
    return flat


def _by_gate(weights: np.ndarray) -> np.ndarray:
    """Columns of the update gate, the reset gate and the candidate as three arrays, each one stretch of memory."""
    return np.ascontiguousarray(weights.reshape(len(weights), 3, -1).transpose(1, 0, 2))


def _unit(state: np.ndarray, given: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the recurrent unit: new state, update and reset gates, candidate, state's share of it.

    ``given``, what the symbols put in, is by gate.
    """
    carried = _by_gate(h @ state)
    gates, own = carried[:2], carried[2]
    gates += given[:2]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    z, r = gates
    n = r * own
    n += given[2]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, own


def _softmax(logits: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of the wanted column; the exponentials and their sum."""
    logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(wanted)), wanted]
    np.exp(logits, out=logits)
    total = logits.sum(axis=1, keepdims=True)
    return chosen - np.log(total[:, 0]), logits, total


def _output(shape: Shape, p: dict[str, np.ndarray], h: np.ndarray, wanted: np.ndarray,
            grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of each wanted symbol given its state; with ``grad`` the gradient too."""
    known = wanted < shape.head
    of_class = np.where(known, wanted // shape.members, wanted - shape.head + shape.classes)
    dh, found = None, np.empty(len(wanted))
    if grad is None:
        for at in range(0, len(wanted), _ROWS):
            cut = slice(at, at + _ROWS)
            found[cut] = _softmax(h[cut] @ p["class"] + p["class_bias"], of_class[cut])[0]
    else:
        found[:], share, total = _softmax(h @ p["class"] + p["class_bias"], of_class)
        share /= total
        share[np.arange(len(wanted)), of_class] -= 1
        grad["class"] += h.T @ share
        grad["class_bias"] += share.sum(axis=0)
        dh = share @ p["class"].T
    at = np.flatnonzero(known)
    at = at[np.argsort(of_class[at].astype(np.uint16), kind="stable")]
    cuts = np.searchsorted(of_class[at], np.arange(shape.classes + 1))
    near, place, logp, d_near = h[at], wanted[at] % shape.members, np.empty(len(at)), np.empty((len(at), h.shape[1]), h.dtype)
    for c in np.flatnonzero(np.diff(cuts)):
        cut = slice(cuts[c], cuts[c + 1])
        logits = near[cut] @ p["word"][c]
        logits += p["word_bias"][c]
        logp[cut], share, total = _softmax(logits, place[cut])
        if grad is not None:
            share /= total
            share[np.arange(len(share)), place[cut]] -= 1
            grad["word"][c] += near[cut].T @ share
            grad["word_bias"][c] += share.sum(axis=0)
            np.matmul(share, p["word"][c].T, out=d_near[cut])
    found[at] += logp
    if grad is not None:
        dh[at] += d_near
    return found, dh


def gradient(shape: Shape, p: dict[str, np.ndarray], read: np.ndarray, wanted: np.ndarray, fresh: np.ndarray,
             h: np.ndarray, grad: dict[str, np.ndarray]) -> tuple[np.ndarray, float]:
    """Adds the gradient of one window (time x lanes) by backpropagation through it; the state after it, and its loss."""
    k, steps, live = shape.hidden, [], (~fresh)[:, :, None]
    given = _by_gate(p["input"]).take(read, axis=1)
    for t in range(len(read)):
        before = h * live[t]
        h, z, r, n, own = _unit(p["state"], given[:, t], before)
        steps.append((before, z, r, n, own, h))
    states = np.concatenate([s[-1] for s in steps])
    found, dh_out = _output(shape, p, states, wanted.ravel(), grad)
    dh_out = dh_out.reshape(len(read), -1, k)
    carry = np.zeros_like(h)
    d_new, d_carried = np.empty((*read.shape, k), np.float32), np.empty((*read.shape, 3 * k), np.float32)
    for t in range(len(read) - 1, -1, -1):
        before, z, r, n, own, _ = steps[t]
        d, d_n, kept = dh_out[t] + carry, d_new[t], 1 - z
        np.multiply(d, kept, out=d_n)
        slope = n * n
        np.subtract(1, slope, out=slope)
        d_n *= slope
        np.subtract(before, n, out=slope)
        slope *= d
        slope *= z
        np.multiply(slope, kept, out=d_carried[t, :, :k])
        np.multiply(d_n, own, out=slope)
        slope *= r
        np.subtract(1, r, out=kept)
        np.multiply(slope, kept, out=d_carried[t, :, k:2 * k])
        np.multiply(d_n, r, out=d_carried[t, :, 2 * k:])
        d *= z
        d += d_carried[t] @ p["state"].T
        d *= live[t]
        carry = d
    d_carried = d_carried.reshape(-1, 3 * k)
    grad["state"] += np.concatenate([s[0] for s in steps]).T @ d_carried
    flat = read.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.append(True, np.diff(ordered) != 0))
    d_given = d_carried[order]
    d_given[:, 2 * k:] = d_new.reshape(-1, k)[order]
    grad["input"][ordered[first]] += np.add.reduceat(d_given, first)
    return h, -float(found.sum())


class Learner:
    """Parameters of one task, moved by Adam steps."""

    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat.copy()
        self.mean, self.square = np.zeros_like(flat), np.zeros_like(flat)
        self.grad, self.room = np.zeros_like(flat), np.empty_like(flat)
        self.steps, self.learned = 0, 0

    def step(self, tokens: int) -> None:
        self.steps += 1
        g, to = self.grad, self.room
        g /= tokens
        np.subtract(g, self.mean, out=to)
        to *= 0.1
        self.mean += to
        g *= g
        g -= self.square
        g *= 0.01
        self.square += g
        up, down = 1 - 0.9 ** self.steps, 1 - 0.99 ** self.steps
        np.divide(self.square, down, out=g)
        np.sqrt(g, out=g)
        g += 1e-6
        np.multiply(self.mean, self.shape.rate / up, out=to)
        to /= g
        self.flat -= to
        g[:] = 0
        self.learned += tokens

    def learn(self, stream: np.ndarray) -> None:
        """Learn from documents laid end to end; each ends with symbol 0."""
        lanes = max(1, min(self.shape.lanes, len(stream) // (_WINDOWS * self.shape.window)))
        length = -(-len(stream) // lanes)
        wanted = np.append(stream, np.zeros(lanes * length - len(stream), stream.dtype)).astype(np.int64)
        read = np.append(0, wanted[:-1]).reshape(lanes, length).T     # what came before
        wanted = wanted.reshape(lanes, length).T
        fresh = read == 0
        p, g = self.shape.views(self.flat), self.shape.views(self.grad)
        h = np.zeros((lanes, self.shape.hidden), np.float32)
        for t in range(0, length, self.shape.window):
            cut = slice(t, t + self.shape.window)
            h, _ = gradient(self.shape, p, read[cut], wanted[cut], fresh[cut], h, g)
            self.step(wanted[cut].size)


def log_likelihoods(shape: Shape, flat: np.ndarray, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log probability of each document of a batch, the state carried over all its windows."""
    p, starts = shape.views(flat), np.cumsum(sizes) - sizes
    out, order = np.zeros(len(sizes)), np.argsort(-sizes, kind="stable")
    for at in range(0, len(order), _LANES):
        docs = order[at:at + _LANES]    # of similar lengths, the longest first
        out[docs] = _lanes(shape, p, symbols, starts[docs], sizes[docs])
    return out


def _lanes(shape: Shape, p: dict[str, np.ndarray], symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out, t = np.zeros(len(sizes)), 0
    h, last = np.zeros((len(sizes), shape.hidden), np.float32), np.zeros(len(sizes), np.int64)
    given = _by_gate(p["input"])
    while t < sizes[0]:
        live = int(np.searchsorted(-sizes, -t, side="left"))     # documents of more than t symbols
        width = int(min(sizes[0] - t, max(8, _TOKENS // live)))
        at = t + np.arange(width)[:, None]
        inside = at < sizes[:live]
        wanted = symbols[np.where(inside, first[:live] + at, 0)].astype(np.int64)
        h, last, states = h[:live], last[:live], []
        for x in wanted:
            h = _unit(p["state"], given.take(last, axis=1), h)[0]
            states.append(h)
            last = x
        spots = np.flatnonzero(inside.ravel())
        found, _ = _output(shape, p, np.concatenate(states)[spots], wanted.ravel()[spots])
        out[:live] += np.bincount(spots % live, found, live)
        t += width
    return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block in lower case; their bytes end to end, their offsets in these, and the words before each row's end."""
    starts, stops, before = words_of(data, offsets)
    at = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(stops - starts, out=at[1:])
    packed = _LOWER[data[~IS_SPACE[data]]]
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)]), packed, at, before


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, c: the tokens of the texts, summed as far as a task holds them."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        for row, stop, data, offsets in blocks(batch.column("text")):
            found = pc.value_counts(_tokens(data, offsets)[0])
            words, c = found.field("values"), found.field("counts")
            held += [pa.table({"word": words, "c": c}),
                     pa.table({"word": pa.array([END], pa.binary()), "c": pa.array([stop - row], pa.int64())})]
            size += len(words)
            if size > 2 * _FLUSH:
                held = [_summed(held)]
                size = held[0].num_rows
                if size > _FLUSH:
                    yield from held[0].to_batches()
                    held, size = [], 0
    if held:
        yield from _summed(held).to_batches()


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")]).select(["word", "c_sum"]).rename_columns(["word", "c"])


def _counts(train: DataFrame) -> DataFrame:
    """word (binary, lower case; the end token is empty), c: the training tokens counted."""
    return train.mapInArrow(_counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _other_class(word: bytes, others: int) -> int:
    return zlib.crc32(word[:1] + word[-1:]) % others


@dataclass
class Words:
    """The words that every task knows: counts, symbols; totals of the other classes."""
    shape: Shape
    n: int
    v: int
    words: list[bytes]
    counts: np.ndarray
    other_counts: np.ndarray
    other_words: np.ndarray

    def symbols(self) -> np.ndarray:
        head, others = self.shape.head, self.shape.others
        return np.array([i if i < head else head + _other_class(w, others) for i, w in enumerate(self.words)]
                        or [0], dtype=np.uint16)


def _words(counts: DataFrame, shape: Shape, dictionary: int, longest: int = 64) -> Words:
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the most frequent words, as many whole steps of frequency as fit: sixteen steps to each doubling
    short = counts.filter((F.length("word") > 0) & (F.length("word") <= longest)).withColumn(
        "step", F.floor(16 * F.log2(F.col("c"))).cast("int"))
    least, room = 0, dictionary - 1
    for r in sorted(short.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        room -= r["count"]
        if room < 0:
            least = r["step"] + 1
            break
    top = counts.filter("length(word) = 0").collect() + sorted(
        short.filter(F.col("step") >= least).select("word", "c").collect(), key=lambda r: (-r.c, bytes(r.word)))
    words, c = [bytes(r.word) for r in top], np.array([r.c for r in top], dtype=np.int64)
    if not words:
        words, c = [END], np.zeros(1, np.int64)
    in_class = F.pmod(F.crc32(F.concat(F.substring("word", 1, 1), F.substring("word", -1, 1))), F.lit(shape.others))
    sums = counts.groupBy(in_class.cast("int").alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    other_counts, other_words = np.zeros(shape.others, np.int64), np.zeros(shape.others, np.int64)
    for r in sums:
        other_counts[r.k], other_words[r.k] = r.c, r.v
    for w, k in zip(words[:shape.head], c[:shape.head].tolist()):     # head words have classes of their own
        if k:
            other_counts[_other_class(w, shape.others)] -= k
            other_words[_other_class(w, shape.others)] -= 1
    return Words(shape, total["n"], total["v"], words, c, other_counts, other_words)


_ENCODED = ["ids", "n_tokens", "n_known", "base_sum", "other_sum", "rest"]


def _encoded(known: Words, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_encode``, block by block: words stay in arrow arrays, all documents of a block at once."""
    shape, symbol, dictionary = known.shape, known.symbols(), pa.array(known.words, pa.binary())
    room = known.other_counts + known.other_words + 1      # one for an unseen word
    base, other = np.log10(known.counts + 1.0), np.zeros(len(known.words))
    far = symbol[shape.head:len(known.words)] - shape.head
    other[shape.head:] = base[shape.head:] - np.log10(room[far])
    ends = [bytes([x]) for x in range(256)]
    class_of = np.array([[_other_class(a + b, shape.others) for b in ends] for a in ends])      # by first and last byte
    for batch in batches:
        for row, stop, data, offsets in blocks(batch.column("text")):
            words, packed, at, before = _tokens(data, offsets)
            n, n_words = stop - row, np.diff(before)
            firsts = before[:-1] + np.arange(n)       # of each document's tokens, its end token included
            code = np.zeros(len(words) + n, dtype=np.int64)      # the end token has code 0
            place = np.arange(len(words)) + np.repeat(np.arange(n), n_words)
            code[place] = pc.fill_null(pc.index_in(words, value_set=dictionary), -1).to_numpy()
            rest = np.flatnonzero(code[place] < 0)
            lost = place[rest]
            far = class_of[packed[at[:-1][rest]], packed[at[1:][rest] - 1]]
            ids, in_base, in_other = symbol[code], base[code], other[code]
            ids[lost] = shape.head + far
            in_base[lost], in_other[lost] = 0.0, -np.log10(room[far])
            met = known.counts[code] > 0
            met[lost] = False
            sizes = np.append(firsts, len(code)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, n), batch.column("held_out").slice(row, n),
                 pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(2 * sizes), pa.py_buffer(ids)]),
                 pa.array(n_words + 1), pa.array(np.add.reduceat(met, firsts, dtype=np.int64)),
                 pa.array(np.add.reduceat(in_base, firsts)), pa.array(np.add.reduceat(in_other, firsts)),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(rest, before).astype(np.int32)), words.take(pa.array(rest)))],
                ["doc_id", "held_out", *_ENCODED])


def _encode(docs: DataFrame, known: Words) -> DataFrame:
    """doc_id, symbols and what the dictionary says of a text; ``rest``: its words outside the dictionary."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(known, batches)

    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, ids binary, n_tokens long, n_known long, "
                                "base_sum double, other_sum double, rest array<binary>")


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a column of packed texts, and how many each has."""
    packed = column.to_pylist()
    sizes = np.array([len(x) // 2 for x in packed], dtype=np.int64)
    return np.frombuffer(b"".join(packed), dtype=np.uint16), sizes


def train(encoded: DataFrame, shape: Shape, flat: np.ndarray, rounds: int) -> np.ndarray:
    """Parameters after ``rounds`` averages; each training row (``n``, ``ids``) is learned from in one round."""
    for number in range(rounds):
        begin = flat

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            learner, held, size = Learner(shape, begin), [], 0
            for batch in batches:
                # slices of some hundred rows bound what is held
                for at in range(0, batch.num_rows, 256):
                    symbols, _ = _symbols(batch.column("ids").slice(at, 256))
                    held.append(symbols)
                    size += len(symbols)
                    if size >= _CHUNK:
                        learner.learn(np.concatenate(held))
                        held, size = [], 0
            if size:
                learner.learn(np.concatenate(held))
            if learner.learned:
                for at in range(0, len(flat), _AVERAGE):
                    part = learner.flat[at:at + _AVERAGE].astype(np.float64) * learner.learned
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at]), pa.array([learner.learned]), pa.array([part.tobytes()], pa.binary())],
                        ["at", "tokens", "part"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            tokens: Counter[int] = Counter()
            for batch in batches:
                for at, n, part in zip(*[batch.column(c).to_pylist() for c in ("at", "tokens", "part")]):
                    values = np.frombuffer(part)
                    sums[at] = sums[at] + values if at in sums else values
                    tokens[at] += n
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sums.keys(), pa.int64()), pa.array([(v / tokens[at]).tobytes() for at, v in sums.items()],
                                                                 pa.binary())], ["at", "part"])

        mine = encoded.filter(F.pmod(F.xxhash64("n"), F.lit(rounds)) == number).select("ids")
        rows = (mine.mapInArrow(learn, "at long, tokens long, part binary").repartition("at")
                .mapInArrow(add, "at long, part binary").collect())
        if rows:
            flat = np.concatenate([np.frombuffer(r.part) for r in sorted(rows, key=lambda r: r.at)]).astype(np.float32)
    return flat


def lm_scores(docs: DataFrame, shape: Shape = Shape(), dictionary: int = 1 << 16, rounds: int = 2, learn_every: int = 1,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Every window is learned from: ``learn_every`` can only be 1.
    """
    if learn_every != 1:
        raise ValueError("every window is learned from")
    slim = pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", held_out(F.col("doc_id")))
    kind = slim.schema["doc_id"].dataType.simpleString()
    counts = materialize(_counts(slim.filter("not held_out").select("text")), "lm-counts")
    known = _words(counts, shape, dictionary)
    encoded = materialize(_encode(slim, known).withColumn("n", F.monotonically_increasing_id()), "lm-symbols")
    flat = start(shape, known.counts[:shape.head], known.other_counts)
    flat = train(encoded.filter("not held_out").select("n", "ids"), shape, flat, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, sizes = _symbols(batch.column("ids"))
            found = log_likelihoods(shape, flat, symbols, sizes) / np.log(10)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], [*names, "lm"])

    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_sum", "other_sum", "n"]
    scored = encoded.select(*names, "ids").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_sum double, other_sum double, "
             "n long, lm double")
    # words outside the dictionary: each is rare, so no key is hot
    rest = encoded.select("n", F.explode("rest").alias("word"))
    tail = rest.join(counts, "word").groupBy("n").agg(F.sum(F.log10(F.col("c") + 1)).alias("tail_sum"),
                                                     F.count(F.lit(1)).alias("tail_known"))
    tail_sum = F.coalesce("tail_sum", F.lit(0.0))
    all_tokens = float(np.log10(known.n + known.v + 1.0))
    return scored.join(tail, "n", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base_sum") + tail_sum - F.col("n_tokens") * all_tokens).alias("base_score"),
        (F.col("lm") + F.col("other_sum") + tail_sum).alias("score"))
