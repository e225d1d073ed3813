"""Operator 4: byte-level BPE on length-bucketed padded numpy matrices.

Every row is a pre-token; each round finds the leftmost pair of least rank of
every row, merges it, closes the gap, and looks up the two pairs that are new.
Pairs are looked up in an open-addressing hash table held in numpy arrays.
Rows that have no pair left leave the matrix, so it shrinks each round.
Pre-tokens of more than LONGEST bytes would need as many rounds, and are
merged by a heap over linked places instead; the results are the same.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common
from cluelake.llm.pretokens import Memo

NONE = np.int32(2**31 - 1)
LONGEST = 256
#: Upper lengths of the buckets; rows are padded to them.
EDGES = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, LONGEST)
#: Cells of a matrix at most.
CELLS = 1_000_000


class PairTable:
    """Merged id of (left id, right id), or NONE."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, NONE, np.int32)
        left, at = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            free = left[self.keys[at[left]] == -1]
            self.keys[at[free]] = pairs[free]  # of those with the same slot the last stays
            won = self.keys[at[left]] == pairs[left]
            self.vals[at[left[won]]] = merged[left[won]]
            left = left[~won]
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shape = a.shape
        key = (a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF)).ravel()
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.vals[at], NONE)
        left = np.flatnonzero((found != key) & (found != -1))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            hit = found == key[left]
            out[left[hit]] = self.vals[at[left[hit]]]
            left = left[~hit & (found != -1)]
        return out.reshape(shape)


class Ranks:
    """A byte-level BPE vocabulary given by the rank of every token's bytes; the rank is the id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, r in ranks.items():
            self.bytes[r] = t
        pairs, merged = [], []
        for t, r in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(r)
        self.table = PairTable(np.array(pairs, np.int64), np.array(merged, np.int32))

    @classmethod
    def tiktoken(cls, path: str) -> Ranks:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a})

    def encode(self, tokens: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each pre-token."""
        out: list[bytes] = [b""] * len(tokens)
        size = np.array([len(t) for t in tokens], np.int64)
        for i in np.flatnonzero(size == 1).tolist():
            out[i] = self.byte[tokens[i][0]].astype("<u4").tobytes()
        for i in np.flatnonzero(size > LONGEST).tolist():
            out[i] = self._heap(tokens[i])
        low = 1
        for high in EDGES:
            rows = np.flatnonzero((size > low) & (size <= high))
            step = max(1, CELLS // high)
            for k in range(0, len(rows), step):
                self._matrix(tokens, size, rows[k : k + step], high, out)
            low = high
        return out

    def _matrix(self, tokens: list[bytes], size: np.ndarray, rows: np.ndarray, width: int, out: list[bytes]) -> None:
        raw = np.frombuffer(b"".join([tokens[i].ljust(width, b"\0") for i in rows.tolist()]), np.uint8).reshape(-1, width)
        n = size[rows].copy()
        ids = np.where(np.arange(width) < n[:, None], self.byte[raw], np.int32(-1))
        rank = self.table.find(ids[:, :-1], ids[:, 1:])
        rank[ids[:, 1:] < 0] = NONE
        while len(rows):
            at = rank.argmin(1)
            line = np.arange(len(rows))
            best = rank[line, at]
            done = best == NONE
            if done.any():
                flat = ids[done].astype("<u4")
                for i, x, k in zip(rows[done].tolist(), flat, n[done].tolist()):
                    out[i] = x[:k].tobytes()
                keep = ~done
                rows, ids, rank, n, at, best = rows[keep], ids[keep], rank[keep], n[keep], at[keep], best[keep]
                line = np.arange(len(rows))
                if not len(rows):
                    return
            w = ids.shape[1] - 1
            col = np.arange(w)
            after = col[None, :] > at[:, None]
            ids = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[line, at] = best
            n -= 1
            if w == 1:
                rank = np.full((len(rows), 1), NONE, np.int32)
                continue
            fresh = np.where(after[:, :-1], rank[:, 1:], rank[:, :-1])
            for j in (at - 1, at):
                ok = np.flatnonzero((j >= 0) & (j < w - 1))
                jj = j[ok]
                a, b = ids[ok, jj], ids[ok, jj + 1]
                v = self.table.find(a, b)
                v[b < 0] = NONE
                fresh[ok, jj] = v
            rank = fresh

    def _heap(self, token: bytes) -> bytes:
        ids = self.byte[np.frombuffer(token, np.uint8)].tolist()
        n, text, ranks = len(ids), self.bytes, self.ranks
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        get = lambda i, j: ranks.get(text[ids[i]] + text[ids[j]])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and (q := get(x, y)) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: Iterable[int]) -> bytes:
        text = self.bytes
        return b"".join([text[i] for i in ids])


_loaded: dict[str, tuple[Ranks, Memo]] = {}


def loaded(path: str, pattern: str) -> tuple[Ranks, Memo]:
    """The vocabulary and what is remembered with it, once for each Python worker."""
    if path not in _loaded:
        ranks = Ranks.tiktoken(path)
        _loaded[path] = ranks, Memo(pattern, lambda new: ranks.encode([t.encode("utf-8", "surrogatepass") for t in new]))
    return _loaded[path]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, finish) -> Iterator[pa.RecordBatch]:
    """finish gets a batch, the packed ids of its column "text" (null: empty) and the vocabulary, and returns a batch."""
    ranks, memo = loaded(path, pattern)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        packed = [v for i, j in common.chunks(texts) for v in memo.values(["" if t is None else t for t in texts[i:j]])]
        yield finish(batch, packed, ranks)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs with one more column "ids" (array of int): the ids of "text", as the tiktoken library gives them without special tokens.

    A null or empty text has no ids. Other columns, whatever their names, stay
    as they are; a column named "ids" is replaced. Rows stay in their partitions.
    """
    common.session(docs.sparkSession)
    kept = [c for c in docs.columns if c != "ids"]
    src = docs.select(*[docs[f"`{c}`"] for c in kept])
    schema = src.withColumn("ids", F.array(F.lit(0))).schema

    def finish(batch, packed, _):
        off = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(packed), "<i4")))
        return pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return src.mapInArrow(lambda it: encode_batches(it, path, pattern, finish), schema)


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """rows with one more column "decoded" (binary): the bytes of "ids". Null ids give null; other columns stay."""
    common.session(rows.sparkSession)
    kept = [c for c in rows.columns if c != "decoded"]
    src = rows.select(*[rows[f"`{c}`"] for c in kept])
    schema = src.withColumn("decoded", F.lit(b"")).schema

    def run(it):
        ranks, _ = loaded(path, pattern)
        for batch in it:
            got = [None if x is None else ranks.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*batch.schema.names, "decoded"])

    return src.mapInArrow(run, schema)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes every text in one pass and keeps digests only.

    A row for each row of docs, repeated ids included. A null text counts as empty.
    """
    common.session(docs.sparkSession)

    def finish(batch, packed, ranks):
        n, a, b = [], [], []
        for p in packed:
            ids = np.frombuffer(p, "<u4").tolist()
            n.append(len(ids))
            a.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            b.append(hashlib.sha256(ranks.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(lambda it: encode_batches(it, path, pattern, finish), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
