"""Byte-level BPE encoding and decoding in two tiers.

Tier 1 holds the whole vocabulary in a minimal perfect hash (hash and
displace: a seed per small bucket sends the tokens of all buckets to
distinct slots of a table exactly as long as the vocabulary); a pre-token
that is a token is resolved by one probe and one byte comparison.  Tier 2
takes the misses: the bytes of the pre-token form a doubly linked list, a
heap holds the adjacent pairs that are tokens by (rank, place), and the
lowest pair is merged until none is left.

Both tiers sit behind a bounded memo in each Python worker, as pre-tokens
repeat.  Documents are independent, so the job is one pass without a
shuffle.  The ranks (bounded by the vocabulary, not by the data) are read on
the driver and broadcast.

Defined cases: a null text is an empty text: no ids, the SHA-256 of nothing.
Repeated rows give repeated results; extra columns are not carried.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from rankwise.llm.tables import pick

#: entries the memo of a worker may hold; it starts anew when full
MEMO_ENTRIES = 250_000
#: longer pre-tokens are not memoised, so the memo has a bound in bytes too
MEMO_KEY_BYTES = 64
#: rows taken from an Arrow batch at a time, so that few texts are Python objects at once
SLICE_ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash of the tokens: slot -> (token, rank)."""

    def __init__(self, ranks: dict[bytes, int], per_bucket: int = 2):
        n = self.n = max(1, len(ranks))
        self.buckets = max(1, n // per_bucket)
        held: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for token in ranks:
            held[xxhash.xxh3_64_intdigest(token) % self.buckets].append(token)
        self.seeds = [0] * self.buckets
        self.slots: list[bytes | None] = [None] * n
        # large buckets first, while most slots are free; a bucket of one takes
        # any free slot, whose number it keeps as a negative seed
        order = sorted((b for b in range(self.buckets) if held[b]), key=lambda b: -len(held[b]))
        many = [b for b in order if len(held[b]) > 1]
        for b in many:
            seed = 1
            while True:
                places = [xxhash.xxh3_64_intdigest(t, seed) % n for t in held[b]]
                if all(self.slots[p] is None for p in places) and len(set(places)) == len(places):
                    break
                seed += 1
            self.seeds[b] = seed
            for place, token in zip(places, held[b]):
                self.slots[place] = token
        free = iter([p for p in range(n) if self.slots[p] is None])
        for b in order[len(many):]:
            place = next(free)
            self.seeds[b] = -place - 1
            self.slots[place] = held[b][0]
        self.ranks = [ranks[t] if t is not None else -1 for t in self.slots]

    def get(self, token: bytes) -> int:
        """The rank of the token, or -1."""
        seed = self.seeds[xxhash.xxh3_64_intdigest(token) % self.buckets]
        place = -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(token, seed) % self.n
        return self.ranks[place] if self.slots[place] == token else -1


def merge(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: a heap of pairs over a linked list of parts."""
    n = len(piece)
    end = list(range(1, n + 1))        # part i is piece[i:end[i]]
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        # stale when a part was merged away or has grown since
        if not alive[i] or (right := end[i]) >= n or end[right] != stop:
            continue
        alive[right] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := rank_of.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (left := before[i]) >= 0 and (r := rank_of.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank_of[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encoder and decoder over one vocabulary and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PerfectHash | None = None):
        self.rank_of = ranks
        self.table = table or PerfectHash(ranks)
        self.tokens = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit integers."""
        raw = piece.encode()
        rank = self.table.get(raw)
        ids = [rank] if rank >= 0 else merge(raw, self.rank_of)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= MEMO_KEY_BYTES:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        get, resolve = self.memo.get, self._piece
        return b"".join([get(p) or resolve(p) for p in self.split(text)])

    def decode(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in struct.unpack(f"<{len(packed) // 4}I", packed)])


_CODECS: dict[int, Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """The codec of this worker, built once and kept between tasks."""
    key, ranks, table = shared.value
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern, table)
    return _CODECS[key]


def _shared(df: DataFrame, path: str, pattern: str):
    """Ranks and perfect hash as a broadcast: their size is that of the vocabulary."""
    ranks = read_ranks(path)
    key = xxhash.xxh3_64_intdigest(repr((path, pattern, len(ranks))))
    return df.sparkSession.sparkContext.broadcast((key, ranks, PerfectHash(ranks)))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(row, SLICE_ROWS)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit, packed)."""
    shared = _shared(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in _slices(batches):
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    slim = pick(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, bytes: the bytes that the ids stand for."""
    shared = _shared(encoded, path, pattern)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in _slices(batches):
            raw = [codec.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), batch.column("ids"), pa.array(raw, pa.binary())],
                ["doc_id", "n_tokens", "ids", "bytes"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary, bytes binary")
