"""BPE, mixing, quality rules, classifier and exact dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame, null_last

from rankwise.llm import bpe, exact_dedup, mixing, quality_gam, quality_rules
from rankwise.llm.blocks import blocks

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_perfect_hash_is_minimal_and_exact(codec):
    assert sorted(codec.table.ranks) == sorted(codec.rank_of.values()) and len(codec.table.slots) == len(codec.rank_of)
    assert all(codec.table.get(t) == r for t, r in list(codec.rank_of.items())[::37])
    assert codec.table.get(b"\xff\xfe no token") == -1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab '\n\t1\u00e9\u4e2d\u3000\x85\x1c", max_size=60))
def test_ids_equal_tiktoken(codec, reference, text):
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_bpe_over_rows(spark, reference):
    rows = documents()
    out = bpe.decode(bpe.encode(frame(spark, rows), PATH, PATTERN), PATH, PATTERN).collect()
    got = null_last((r.doc_id, r.n_tokens, bytes(r.ids).hex(), bytes(r.bytes).hex()) for r in out)
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes().hex(), (t or "").encode().hex()))
    assert got == null_last(want)


def naive_targets(sizes, weights, ceiling):
    """Share by weight, stop at the ceiling, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > ceiling * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = float(ceiling * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix(spark):
    rows = documents(n=80) + [(5000 + i, "x " * 400, "big") for i in range(9)]
    got = [r for r in mixing.mix(frame(spark, rows)).collect()]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = naive_targets(sizes, [1, 2, 3], 3)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        u = int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:20".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert r.copies == int(rate) + (u < rate - int(rate)) and r.taken == r.copies * r.size <= 3 * r.size
    again = mixing.mix(frame(spark, rows[::-1])).collect()
    assert null_last((r.doc_id, r.taken) for r in again) == null_last((r.doc_id, r.taken) for r in got)
    whole = mixing.repeat_rows(frame(spark, rows))
    assert whole.columns == frame(spark, rows).columns
    assert Counter(r.doc_id for r in whole.collect()) == +Counter({
        i: sum(r.copies for r in got if r.doc_id == i) for i in {r.doc_id for r in got}})


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [(1, None, None)]).filter("false")).count() == 0
    r = mixing.mix(frame(spark, [(1, None, None)])).first()
    assert (r["size"], r.target, r.taken) == (0, 0.0, 0)


def naive_quality(text, min_words):
    w = (text or "").encode().split()
    n = len(w)
    longest = [0] * n
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and w[i + k] == w[j + k]:
                k += 1
            longest[i], longest[j] = max(longest[i], k), max(longest[j], k)
    three = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    repeat = {i + d for i in range(n - 2) if three[tuple(w[i:i + 3])] > 1 for d in range(3)}
    cover = {i + d for i in range(n) if longest[i] >= min_words for d in range(longest[i])}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (n, sum(map(len, WORD.findall(text or ""))), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(repeat), len(cover), max(longest, default=0))


@pytest.mark.parametrize("limit", [50, 2 << 20])
def test_repetition_counts_equal_brute_force(limit):
    rnd = random.Random(5)
    texts = [None, "", " \n ", "ä ä\nä ä\n\nä", "a b c # d|" * 30]
    for _ in range(150):
        n, v = rnd.choice([1, 3, 20, 70]), rnd.choice([1, 2, 3, 12])
        texts.append("".join(f"{rnd.randrange(v)}{rnd.choice([' ', ' ', chr(10)])}" for _ in range(n)))
    for row, stop, data, offsets in blocks(pa.array(texts), limit):
        m = quality_rules.measure(data, offsets, 4)
        for k in range(row, stop):
            got = tuple(int(m[c][k - row]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                     "n_covered_words", "longest_repeat"))
            assert got == naive_quality(texts[k], 4), texts[k]


def test_quality_rules_verdict(spark):
    rnd = random.Random(9)
    clean = " ".join(f"w{rnd.randrange(5000)}" for _ in range(300))
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(1, clean, "a"), (2, f"{clean} {passage} {clean[:40]} {passage}", "a"), (3, "few words", "a"), (4, None, "a"),
            (5, "spam ham " * 200, "a"), (1, clean, "a")]
    got = {(r.doc_id, r.base_failed, r.kept) for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    assert got == {(1, False, True), (2, False, False), (3, True, False), (4, True, False), (5, True, False)}


def test_each_repeat_limit_decides_alone(spark):
    word = (f"w{k}" for k in range(10 ** 6))
    fresh = lambda n: [next(word) for _ in range(n)]
    covered, short, long_one = fresh(12), fresh(8), fresh(55)
    texts = [fresh(30) + covered + fresh(20) + covered + fresh(10),             # 24 of 84 words
             fresh(40) + short + fresh(20) + short + fresh(10),                 # 16 of 86 words
             fresh(900) + long_one + fresh(20) + long_one]                      # 110 of 1,030 words
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    assert [(r.base_failed, r.kept) for _, r in sorted(got.items())] == [(False, False), (False, True), (False, False)]
    assert got[0].longest_repeat == 12 and got[2].n_covered_words == 110


def test_classifier_learns_and_holds_out(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = rnd.random() < 0.7
        word = lambda: "".join(rnd.choice("abcdefg") for _ in range(5)) + ("" if good else rnd.choice(["***", "$$$"]))
        rows.append((i, " ".join(word() for _ in range(30)), "a"))
        labels.append((i, int(good), None))
    labels += [(7, None, 1), (None, 1, 1), (9999, 1, 0)]
    docs = frame(spark, rows + [(5000, None, None), (None, "", None)])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_gam.train(docs, known, max_train_rows=200)
    got = {r.doc_id: r for r in quality_gam.score(docs, model).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    out = [(got[i].predicted, q) for i, q, _ in labels[:400] if got[i].held_out]
    assert len(out) > 40 and sum(p == q for p, q in out) / len(out) > 0.95
    kept = quality_gam.keep_good(docs, model)
    assert kept.columns == docs.columns and null_last((r.doc_id,) for r in kept.collect()) == null_last(
        (i,) for i, r in got.items() if r.predicted)
    nobody = quality_gam.train(docs, known.filter("false"))
    assert {r.score for r in quality_gam.score(docs, nobody).collect()} == {0.5}


def test_training_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"word{i} " * 20, "a") for i in ids] + [(ids[3], f"other{k} *** text", "a") for k in range(200)]
    known = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    seen, made = [], quality_gam.feature_rows

    def noted(docs, keep):
        seen.append(sorted(map(tuple, docs.select("doc_id", "text").collect())))
        return made(docs, keep)

    monkeypatch.setattr(quality_gam, "feature_rows", noted)
    for order in (rows, rows[::-1]):
        quality_gam.train(frame(spark, order), known)
    assert seen[0] == seen[1] and [i for i, _ in seen[0]] == ids


def naive_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    keep = {}
    for (i, _, _), n in zip(rows, norm):
        best = keep.get(n)
        keep[n] = i if n not in keep or (i is not None and (best is None or i < best)) else best
    taken, out = set(), []
    for (i, _, _), n in zip(rows, norm):
        first = i == keep[n] and (i, n) not in taken
        taken.add((i, n))
        out.append((i, keep[n], norm.count(n), first, hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_exact_dedup(spark):
    rows = documents(n=80) + [(3000 + k, "one\n two", "a") for k in range(40)]
    df = frame(spark, rows)
    got = [tuple(r) for r in exact_dedup.exact_dedup(df).collect()]
    assert null_last(got) == null_last(naive_exact(rows))
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert null_last((r.doc_id,) for r in kept.collect()) == null_last((g[0],) for g in got if g[3])
    assert exact_dedup.exact_dedup(df.filter("false")).count() == 0


def test_memo_stays_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 10)
    small = bpe.Codec(codec.rank_of, PATTERN, codec.table)
    small.encode(" ".join(f"qx{k}zz" for k in range(200)))
    assert len(small.memo) <= 10
