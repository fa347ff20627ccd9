"""The corpus pipeline: quality classifier, exact dedup, near dedup, source mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns what stays; all but the last return the columns of ``documents``.
``run`` writes every stage as Parquet to the shared folder and reads it again;
a stage and its intermediate tables go once the next one is written, so only
the last stage's table is left.

Defined cases: documents with a null text count as empty texts, repeated rows
(same id, same text) become one in the second stage, null ids are never near
duplicates, extra columns are carried up to the last stage, whatever their
names, and an empty table gives an empty result.  Long texts are read whole.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankwise.functions.materialize import drop_folder, workspace
from rankwise.llm import bpe, exact_dedup, mixing, quality_gam, shingle_join
from rankwise.llm.queries import VOCABULARY
from rankwise.llm.tables import scan
from rankwise.session import checkpoint_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the additive model, fitted on the labelled rows, does not reject."""
    return quality_gam.keep_good(docs, quality_gam.train(docs, scan(spark, sf_dir, "labels")), threshold=0.3)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the smallest id."""
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (similarity 0.8 or more) the smallest id."""
    return shingle_join.keep_one(docs, size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix to the target weights takes it."""
    return mixing.repeat_rows(docs, weights=[1, 2, 3], max_repeat=3)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids: the token ids of the whole text, packed."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_duplicates),
          ("n-gram Jaccard join", near_duplicates), ("source mix", source_mix), ("byte-level BPE", byte_bpe)]

#: classifier, similarity join and BPE are beyond SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, one per copy that the mix takes."""
    docs, before = scan(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = checkpoint_path(spark, f"rankwise-pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}")
        with workspace(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
