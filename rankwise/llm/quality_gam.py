"""Quality classifier: a generalised additive model with pairwise interactions.

logit(score) = intercept + sum of one lookup table per feature + sum of one
two-way table per chosen pair of features.  Tables are learned by cyclic
boosting: round after round, each feature in turn gets one shallow tree on
the gradient of the log loss, and the tree's leaves are added, shrunken, to
the table of that feature; the best pairs by gain on what is left are then
boosted the same way.  A document is scored by binning its features and
adding table entries, for a whole Arrow batch at once.

Features come from the whole text alone; ids, languages, sources and labels
are never inputs.  The model is fitted on the driver on at most
``max_train_rows`` labelled rows (those of lowest hash, so reruns agree),
the only bounded sample here: their ids are broadcast, 16 bytes each.
Scoring is one pass without a shuffle.

Defined cases: a null text is an empty text and gets a score like any other.
Null labels and labels of unknown documents are skipped; of repeated labels
of a document the smallest counts.  Without labels of both classes every
score is the share of label 1 seen (0.5 if none).  Repeated rows give
repeated results; extra columns are not carried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.llm.blocks import IS_SPACE, blocks, counts_by_row
from rankwise.llm.tables import pick

FEATURES = ["log_words", "word_length", "upper", "digit", "hash_star", "bang", "pipe", "other_mark", "non_ascii",
            "line_words", "dup_lines", "distinct_words", "top_word", "top_pair", "distinct_pairs", "marked_words"]


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


_CLASSES = {"upper": _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit": _class(b"0123456789"),
            "hash_star": _class(b"#*$%&"), "bang": _class(b"!?"), "pipe": _class(b"|<>{}[]\\~^="),
            "other_mark": _class(b"@/_;:+"), "non_ascii": np.arange(256) >= 0x80}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each row of a block."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    put = {name: out[:, i] for i, name in enumerate(FEATURES)}
    solid = np.maximum(1, counts_by_row(~IS_SPACE[data], offsets))
    for name, table in _CLASSES.items():
        put[name][:] = counts_by_row(table[data], offsets) / solid
    for row in range(n):
        text = data[offsets[row]:offsets[row + 1]].tobytes()
        words = text.split()
        if not words:
            continue
        k = len(words)
        seen, pairs = Counter(words), Counter(zip(words, words[1:]))
        lines = [x for x in text.split(b"\n") if x.strip()]
        put["log_words"][row] = np.log1p(k)
        put["word_length"][row] = solid[row] / k
        put["line_words"][row] = np.log1p(k / len(lines))
        put["dup_lines"][row] = 1 - len(set(lines)) / len(lines)
        put["distinct_words"][row] = len(seen) / k
        put["top_word"][row] = max(seen.values()) / k
        put["distinct_pairs"][row] = len(pairs) / max(1, k - 1)
        put["top_pair"][row] = max(pairs.values(), default=0) / max(1, k - 1)
        put["marked_words"][row] = sum(c for w, c in seen.items() if not w[-1:].isalnum() and w[-1] < 0x80) / k
    return out


@dataclass
class Model:
    """Bin edges per feature, one table per feature, one per pair."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], side="right"),
                           np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values by bin of a tree with at most ``leaves`` leaves, grown by best gain."""
    parts, value = [(0, len(g))], np.zeros(len(g))
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gt, ht = g[a:b].sum(), h[a:b].sum()
            gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
            cut = int(np.argmax(gain))
            if gain[cut] > best[0]:
                best = (gain[cut], k, a + cut + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    for a, b in parts:
        value[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best two-by-two cut of a grid of bins."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gt, ht = cg[-1, -1], ch[-1, -1]
    gain, quarters = np.zeros((g.shape[0] - 1, g.shape[1] - 1)), []
    if not gain.size:
        return 0.0, np.zeros(g.shape)
    for gq, hq in ((cg[:-1, :-1], ch[:-1, :-1]), (cg[:-1, -1:] - cg[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1]),
                   (cg[-1:, :-1] - cg[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]),
                   (gt - cg[:-1, -1:] - cg[-1:, :-1] + cg[:-1, :-1], ht - ch[:-1, -1:] - ch[-1:, :-1] + ch[:-1, :-1])):
        gain += gq ** 2 / (hq + 1)
        quarters.append((gq, hq))
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = np.zeros(g.shape)
    for (gq, hq), rows, cols in zip(quarters, (slice(0, r + 1), slice(0, r + 1), slice(r + 1, None), slice(r + 1, None)),
                                    (slice(0, c + 1), slice(c + 1, None), slice(0, c + 1), slice(c + 1, None))):
        value[rows, cols] = _leaf(gq[r, c], hq[r, c])
    return float(gain[r, c] - gt ** 2 / (ht + 1)), value


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 48, leaves: int = 3,
        n_pairs: int = 6, pair_bins: int = 12) -> Model:
    """Cyclic boosting of the tables, then of the best pairs."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    width = x.shape[1]
    model = Model(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [_cuts(x[:, j], bins) for j in range(width)]
    model.coarse = [_cuts(x[:, j], pair_bins) for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(width)]
    wide = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(width)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), leaves)
            model.tables[j] += step
            total += step[fine[j]]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        na, nb = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        return np.bincount(wide[a] * nb + wide[b], v, na * nb).reshape(na, nb)

    g, h = slopes()
    gains = sorted(((-_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b)
                    for a in range(width) for b in range(a + 1, width)))
    model.pairs = [(a, b) for gain, a, b in gains[:n_pairs] if gain < 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 3):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            model.pair_tables[k] += step
            total += step[wide[a], wide[b]]
    return model


def held_out(id_column: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def feature_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of (doc_id, text, ...) beside an array of features."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in blocks(batch.column("text")):
                x = features(data, offsets)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(row, stop - row) for c in keep], flat],
                                                 [*keep, "features"])

    return docs.select(*keep, "text").mapInArrow(
        run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", features array<double>")


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on at most ``max_train_rows`` labelled rows that are not held out."""
    known = (pick(labels, doc_id=id_col, label=label_col).filter("doc_id is not null and label is not null")
             .filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    # one row per id, the same one whatever the order of rows
    rows = (pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(known), "doc_id")
            .groupBy("doc_id").agg(F.min("label").alias("label"),
                                   F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
            .select("doc_id", "label", "least.text"))
    found = feature_rows(rows, ["doc_id", "label"]).toPandas().sort_values("doc_id")
    x = np.array(found["features"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    return fit(x, found["label"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Model, threshold: float = 0.3,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    slim = pick(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, stop - row), pa.array(model.score(features(data, offsets)))],
                    ["doc_id", "score"])

    return slim.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts as quality 1, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in blocks(batch.column(text_col)):
                good = model.score(features(data, offsets)) >= threshold
                yield batch.slice(row, stop - row).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
