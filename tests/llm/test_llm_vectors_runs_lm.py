"""Whitening, periodic runs and the gated language model against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame, null_last, words
from pyspark.sql.types import LongType, StructField

from rankwise.llm import gated_lm, periodic_runs, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- whitening ----------------------------------------------------------------

def vectors(spark, rows):
    data = [(i, v, "k", 3, 1.0) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, x string, n int, component double").repartition(3)


def plain_whitening(rows, k):
    """Exact integers, then the eigenvalues of the plain covariance."""
    x = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in rows}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    deviation = {i: sum(int(n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}
    centre = {i: ((n * np.array(v, dtype=object) - sums) / n).astype(float) for i, v in x.items()}
    return n, deviation, centre, cov, values[:k], values.sum()


def test_whitening_against_plain_eigenvalues(spark):
    rnd = np.random.default_rng(3)
    mix = rnd.normal(size=(9, 9)) * np.array([5, 4, 3, 2, 1, .5, .3, .2, .1])
    good = [(i, (rnd.normal(size=9) @ mix).astype(np.float32).tolist()) for i in range(80)]
    good += [(100 + i, good[0][1]) for i in range(40)]          # copies count once in the fit list
    odd = [(200, None), (201, [None] * 9), (202, [float("nan")] * 9), (203, [float("inf")] + [0.0] * 8), (204, []),
           (205, [1.0, 2.0])]
    got = whitening.whiten(vectors(spark, good + odd), k=4).collect()
    n, deviation, centre, cov, values, trace = plain_whitening(good, 4)
    assert sorted({r.vec_id for r in got}) == sorted(deviation) and len(got) == 4 * len(deviation)
    assert {r.n for r in got} == {n} and n == 80
    assert all(r.deviation == deviation[r.vec_id] for r in got)
    assert all(abs(r.explained - values[r.component - 1] / trace) < 1e-9 * r.explained for r in got)
    assert all(0 <= r.identity_error < 1e-9 for r in got)
    # a component is a direction in which V only scales; either sign
    white = {(r.vec_id, r.component): r.whitened for r in got}
    for c in range(1, 5):
        vector = np.linalg.eigh(cov)[1][:, -c]
        want = {i: float(v @ vector) / math.sqrt(values[c - 1]) for i, v in centre.items()}
        sign = 1 if white[0, c] * want[0] > 0 else -1
        assert all(abs(white[i, c] - sign * w) < 1e-7 for i, w in want.items())


def test_whitening_odd_tables(spark):
    empty = whitening.whiten(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                       "identity_error"]
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []   # no spread
    line = whitening.whiten(vectors(spark, [(None, [0.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])])).collect()
    assert [(r.vec_id, r.component, round(abs(r.whitened), 9)) for r in line].count((1, 1, 1.0)) == 2
    assert len(line) == 3 and {r.deviation for r in line} == {2 * 64 * 64}
    # numbers for which 64 bits are too few; the second component is below the rounding of the first
    far = whitening.whiten(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert len(far) == 3 and {r.deviation for r in far if r.vec_id == 1} == {None}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 99))
def test_factor_and_rotations(width, rank, seed):
    a = np.random.default_rng(seed).normal(size=(width, min(rank, width))) * 10.0 ** np.arange(min(rank, width))
    v = a @ a.T
    factor = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v, atol=1e-9 * np.abs(v).max())
    values, parts = whitening.one_sided_jacobi(factor)
    assert np.allclose((parts * values) @ parts.T, v, atol=1e-9 * np.abs(v).max())
    assert np.allclose(parts.T @ parts, np.eye(len(values)), atol=1e-6) and (np.diff(values) <= 0).all()


# -- periodic runs ------------------------------------------------------------

def plain_runs(words_, min_words=6, min_periods=4):
    """Every stretch by every period; a stretch of a smaller period is that one's."""
    n, found = len(words_), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words_[j] == words_[j + q]:
                j += 1
            if j - i + q >= max(min_words, min_periods * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((s, l, q) for (s, l), q in found.items())


def plain_looped(words_, doc_id):
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words_), h // 10
    if h % 10 or not n:
        return list(words_)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words_[i] if i < a else words_[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    ws = plain_looped(WORD.findall(text or ""), doc_id)
    found = plain_runs(ws)
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None,
            sha("".join(f"{s},{l},{q}\n" for s, l, q in found)),
            sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40) | st.lists(st.sampled_from("abc"), max_size=6).map(lambda x: x * 7)
                | st.lists(st.sampled_from("ab"), max_size=9).map(lambda x: ["c"] + x * 5 + x[:2] + ["c"]), max_size=4))
def test_runs_of_several_texts_at_once(texts):
    ids = np.array([ord(w) - 97 for t in texts for w in t], dtype=np.int64)
    row_of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want, first = [], 0
    for t in texts:
        want += [(s + first, l, q) for s, l, q in plain_runs(t)]
        first += len(t)
    assert [tuple(r) for r in periodic_runs.runs(ids, row_of, 6, 4).tolist()] == want


def looping_rows():
    rnd, rows = random.Random(4), documents()
    for i in range(2000, 2400):
        kind = rnd.randrange(4)
        if kind == 0:
            text = words(rnd, rnd.randrange(1, 60), 3)
        elif kind == 1:
            text = " ".join([words(rnd, 5), " ".join([words(rnd, rnd.randrange(1, 12))] * rnd.randrange(2, 9)), words(rnd, 5)])
        else:
            text = words(rnd, rnd.randrange(0, 80))
        rows.append((i, text, "a"))
    rows.append((9001, "x " * 5000, "a"))
    return rows


def test_periodic_runs(spark):
    rows = looping_rows()
    got = periodic_runs.periodic_runs(frame(spark, rows), rewrite=periodic_runs.looped).collect()
    assert null_last(tuple(r) for r in got) == null_last(plain_row(i, t) for i, t, _ in rows)
    assert sum(r.n_runs > 0 for r in got) > 50      # the test is about texts with runs
    assert periodic_runs.periodic_runs(frame(spark, [])).collect() == []


# -- gated language model -----------------------------------------------------

SMALL = gated_lm.Shape(hidden=4, classes=2, members=3, others=3, window=5, lanes=2)


def small_model(seed=5):
    rnd = np.random.default_rng(seed)
    return gated_lm.start(SMALL, np.array([5, 4, 3, 2, 1]), np.array([3, 0, 2])) + rnd.normal(
        0, 0.5, SMALL.size()).astype(np.float32)


def plain_likelihood(p, symbols):
    """One document, one symbol after the other."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, last, total, k = np.zeros(4), 0, 0.0, 4
    for s in symbols:
        g, u = p["input"][last].astype(float), h @ p["state"].astype(float)
        z, r = sigmoid(g[:k] + u[:k]), sigmoid(g[k:2 * k] + u[k:2 * k])
        h = (1 - z) * np.tanh(g[2 * k:] + r * u[2 * k:]) + z * h
        logits = h @ p["class"] + p["class_bias"]
        c = s // 3 if s < 6 else s - 6 + 2
        total += logits[c] - np.log(np.exp(logits).sum())
        if s < 6:
            logits = h @ p["word"][c] + p["word_bias"][c]
            total += logits[s % 3] - np.log(np.exp(logits).sum())
        last = s
    return total


def test_likelihoods_carry_the_state_through_every_window(monkeypatch):
    rnd = np.random.default_rng(1)
    texts = [np.append(rnd.integers(0, 9, n), 0).astype(np.uint16) for n in (0, 1, 3, 40, 41, 300, 7)]
    monkeypatch.setattr(gated_lm, "_LANES", 3)
    monkeypatch.setattr(gated_lm, "_TOKENS", 16)
    flat = small_model()
    got = gated_lm.log_likelihoods(SMALL, flat, np.concatenate(texts), np.array([len(t) for t in texts]))
    want = [plain_likelihood(SMALL.views(flat), t.tolist()) for t in texts]
    assert np.allclose(got, want, rtol=1e-4)
    # the model is a distribution over symbols: two symbols from the start, all nine times nine
    pairs = np.array([[a, b] for a in range(9) for b in range(9)], dtype=np.uint16)
    p = np.exp(gated_lm.log_likelihoods(SMALL, flat, pairs.ravel(), np.full(81, 2)))
    assert abs(p.sum() - 1) < 1e-5


def test_gradient_is_the_slope():
    rnd = np.random.default_rng(2)
    wanted = rnd.integers(0, 9, (5, 2))
    read = np.concatenate([np.zeros((1, 2), int), wanted[:-1]])
    fresh, h = read == 0, rnd.normal(0, 0.3, (2, 4)).astype(np.float32)
    flat, grad = small_model(), np.zeros(SMALL.size(), np.float32)
    gated_lm.gradient(SMALL, SMALL.views(flat), read, wanted, fresh, h, SMALL.views(grad))

    def loss(x):
        return gated_lm.gradient(SMALL, SMALL.views(x), read, wanted, fresh, h,
                                 SMALL.views(np.zeros_like(grad)))[1]

    for at in rnd.choice(SMALL.size(), 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - grad[at]) < 2e-2 + 2e-2 * abs(grad[at])


def lm_rows():
    """Each word says which one follows."""
    rnd, rows = random.Random(6), documents()
    after = {w: f"W{(7 * w + 1) % 30}" for w in range(30)}
    for i in range(3000, 3200):
        w, text = rnd.randrange(30), []
        for _ in range(rnd.randrange(1, 120)):
            text.append(f"W{w}" if rnd.random() < 0.95 else f"rare{rnd.randrange(500)}")
            w = int(after[w][1:])
        rows.append((i, " ".join(text), "a"))
    return rows


@pytest.mark.parametrize("dictionary", [12, 4096])
def test_lm_scores(spark, dictionary):
    """Base scores as in a plain count, whether words are in the dictionary or not; the model beats them."""
    rows = lm_rows()
    token = lambda t: [w.encode().lower() for w in WORD.findall(t or "")] + [b""]
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter(w for i, t, _ in rows if not out(i) for w in token(t))
    n, v = sum(counts.values()), len(counts)
    want = null_last((i, out(i), len(token(t)), sum(counts[w] > 0 for w in token(t)), n,
                      round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in token(t)), 6)) for i, t, _ in rows)
    shape = gated_lm.Shape(hidden=8, classes=2, members=20, others=4, window=8, rate=0.05)
    got = gated_lm.lm_scores(frame(spark, rows), shape=shape, dictionary=dictionary, learn_every=1).collect()
    assert null_last((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 3000 and r.n_tokens > 20]
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held) > 0


def test_lm_without_training_rows(spark):
    empty = gated_lm.lm_scores(frame(spark, []))
    assert empty.collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = gated_lm.lm_scores(frame(spark, [(held, "a b", "a"), (held, None, "a")])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_every_window_is_learned_from(monkeypatch):
    """the gradient is taken at every position of a stream, whatever its place."""
    monkeypatch.setattr(gated_lm, "_WINDOWS", 1)
    seen, plain = [], gated_lm.gradient

    def gradient(shape, p, read, wanted, *rest):
        seen.append(wanted.copy())
        return plain(shape, p, read, wanted, *rest)

    monkeypatch.setattr(gated_lm, "gradient", gradient)
    flat = gated_lm.start(SMALL, np.array([5, 4, 3, 2, 1]), np.array([3, 0, 2]))
    stream = np.array([1, 2, 3, 0] * 23 + [4, 0], dtype=np.uint16)
    learner = gated_lm.Learner(SMALL, flat)
    learner.learn(stream)
    lanes = np.concatenate(seen).T       # lanes of the stream end to end
    assert lanes.ravel()[:len(stream)].tolist() == stream.tolist()
    assert learner.learned == lanes.size and learner.steps == len(seen)


class Batches:
    """Stands for a table: keeps what a partition's batches become."""

    def __init__(self, *batches):
        self.batches, self.schema = batches, {"doc_id": StructField("doc_id", LongType())}

    def mapInArrow(self, run, schema):
        self.run = lambda: list(run(iter(self.batches)))
        return self


def test_encoding_follows_blocks_not_words():
    """the calls of encoding do not grow with the words, known or not; its rows are those of a plain loop."""
    rnd = random.Random(8)
    known = gated_lm.Words(SMALL, 100, 40, [b"", *(f"w{i}".encode() for i in range(9))], np.arange(30, 20, -1),
                           np.array([9, 8, 7]), np.array([3, 2, 1]))
    room = [13, 11, 9]

    def plain(text):
        ids, base, other, rest = [], 0.0, 0.0, []
        for w in [w.encode().lower() for w in WORD.findall(text or "")] + [b""]:
            far = zlib.crc32(w[:1] + w[-1:]) % 3
            if w in known.words:
                i = known.words.index(w)
                base += math.log10(known.counts[i] + 1)
                other += math.log10(known.counts[i] + 1) - math.log10(room[far]) if i >= 6 else 0
            else:
                i = 6
                other -= math.log10(room[far])
                rest.append(w)
            ids.append(i if i < 6 else 6 + far)
        return (np.array(ids, np.uint16).tobytes(), len(ids), len(ids) - len(rest), rest, base, other)

    calls = []
    for words in (20, 2000):
        texts = [None, "", " \n", " é\x0bW3 "] + [" ".join(rnd.choice(["W1", "w7", f"x{rnd.random()}", "É\t"]) for _ in range(words))
                                                 for _ in range(20)]
        batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts),
                                 "held_out": pa.array([False] * len(texts))})
        docs, seen = Batches(batch), []
        gated_lm._encode(docs, known)
        sys.setprofile(lambda _, event, __: seen.append(event) if "call" in event else None)
        got = docs.run()
        sys.setprofile(None)
        calls.append(len(seen))
        got, want = [r for b in got for r in b.to_pylist()], [plain(t) for t in texts]
        assert [(r["ids"], r["n_tokens"], r["n_known"], r["rest"]) for r in got] == [w[:4] for w in want]
        assert np.allclose([(r["base_sum"], r["other_sum"]) for r in got], [w[4:] for w in want], rtol=1e-12)
    assert calls[1] < calls[0] + 1000     # of 39,600 words more


def test_counting_in_parts(monkeypatch):
    """Sums of a task that flushes after every block."""
    monkeypatch.setattr(gated_lm, "_FLUSH", 3)
    batches = [pa.record_batch({"text": pa.array(t)}) for t in (["a B a", None, ""], ["b\tc d e f g a", "a"], ["H a"])]
    got = Counter()
    for part in gated_lm._counted(iter(batches)):
        for r in part.to_pylist():
            got[r["word"]] += r["c"]
    assert got == Counter(b"a b a b c d e f g a a h a".split()) + Counter({b"": 6})


def test_gates_are_stretches_of_memory(monkeypatch):
    """the recurrent unit works on whole arrays, not on slices of rows."""
    seen, plain = [], gated_lm._unit
    monkeypatch.setattr(gated_lm, "_unit", lambda *parts: seen.append(plain(*parts)) or seen[-1])
    flat, wanted = small_model(), np.array([[1, 2], [3, 0]])
    gated_lm.gradient(SMALL, SMALL.views(flat), wanted, wanted, wanted == 0, np.zeros((2, 4), np.float32),
                      SMALL.views(np.zeros_like(flat)))
    gated_lm.log_likelihoods(SMALL, flat, np.array([1, 2, 0, 3, 0], np.uint16), np.array([3, 2]))
    assert len(seen) == 5 and all(part.flags.c_contiguous for parts in seen for part in parts)
