"""The pipeline, stage by stage against plain Python, and the queries' contract columns."""

from __future__ import annotations

import os
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from llm_cases import documents, null_last, words
from test_llm_joins import naive_components
from test_llm_text_ops import naive_exact, naive_targets

import corpus_pipeline
from rankwise.llm import bpe, quality_gam, queries
from rankwise.llm.tables import scan
from rankwise.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    rnd = random.Random(12)
    docs = [(i, t, "en", s, len(t or "")) for i, t, s in documents(seed=20, n=120)]
    docs += [(6000 + k, " ".join(f"{w}***" for w in words(rnd, 40).split()), "en", "a", 0) for k in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{base}/documents.parquet")
    labels = [(i, int(i < 6000), 0) for i, t, *_ in docs if i is not None and t and len(t) > 20]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


def test_stages(spark, folder, tmp_path):
    docs = scan(spark, folder, "documents")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        if k < 4:
            assert out.columns == columns, name
            kept = [(r.doc_id, r.text, r.source) for r in out.collect()]
        if name == "quality classifier":
            model = quality_gam.train(docs, scan(spark, folder, "labels"))
            bad = {i for i, _, _ in rows if i is not None and i >= 6000}
            assert not bad & {i for i, _, _ in kept} and len(kept) >= len(rows) - len(bad) - 6
            assert null_last(kept) == null_last(
                [(r.doc_id, t, s) for r, (t, s) in _beside(quality_gam.score(docs, model).collect(), rows) if r.predicted])
        elif name == "exact dedup":
            want = [r for r, d in zip(rows, naive_exact(rows)) if d[3]]
            assert null_last((i, t) for i, t, _ in kept) == null_last((i, t) for i, t, _ in want)
        elif name == "n-gram Jaccard join":
            want = [r for r, c in zip(rows, naive_components(rows)) if c[2] == c[0]]
            assert null_last(kept) == null_last(want)
        elif name == "source mix":
            sizes = Counter()
            for _, t, s in rows:
                sizes[s] += len((t or "").encode().split())
            target = naive_targets(sizes, [1, 2, 3], 3)
            times = Counter(kept)
            for r in rows:
                rate = target[r[2]] / sizes[r[2]] if sizes[r[2]] else 0
                assert int(rate) <= times[r] <= int(rate) + 1 <= 4
        else:
            enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
                public_tokenizers.path(queries.VOCABULARY)))
            got = Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in out.collect())
            want = Counter()
            for i, t, _ in rows:
                ids = enc.encode_ordinary(t or "")
                want[(i, len(ids), b"".join(x.to_bytes(4, "little") for x in ids))] += 1
            assert got == want
        docs = out


def test_run_leaves_only_the_last_stage(spark, folder):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = corpus_pipeline.run(spark, folder)
    left = set(os.listdir(base)) - before
    assert len(left) == 1 and "byte-level-BPE" in left.pop()
    assert out.count() > 0      # and it can be read


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for name, query in queries.queries().items():
        out = query(spark, str(tmp_path))
        assert set(CONTRACT[name]) <= set(out.columns) and out.collect() == [], name
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def _beside(scored, rows):
    """Each scored row with a text and source of its id (rows of one id have one text here)."""
    of = {}
    for i, t, s in rows:
        of.setdefault(i, []).append((t, s))
    return [(r, of[r.doc_id].pop()) for r in scored]


CONTRACT = {
    "op1_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_suffix_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_quality_gam": ["doc_id", "held_out", "score", "predicted"],
    "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op6_line_dedup": ["doc_id", "n_lines", "n_removed", "kept_sha256"],
    "op7_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op8_html_wrappers": ["page_id", "url", "text", "n_chars"],
    "op9_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op10_shingle_join": ["doc_id", "n_shingles", "component_id"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_gated_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


def test_every_operator_has_its_query():
    assert set(queries.queries()) == set(CONTRACT)
    assert set(queries.oracle_sql()) <= set(CONTRACT)


@pytest.mark.parametrize("name", ["op2_source_mix", "op6_line_dedup", "op7_url_filter", "op9_exact_dedup"])
def test_query_equals_its_sql(spark, name):
    import duckdb
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    got = queries.queries()[name](spark, folder)
    assert got.columns == CONTRACT[name]
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(map(str, (tuple(r[c] for c in want.columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))
