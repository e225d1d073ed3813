"""Operator 12: SimHash fingerprints of documents, and the search for all within a Hamming radius.

A text's terms are its distinct words and 5-word shingles (lower-cased A-Z),
each with a weight that grows with the logarithm of how often it occurs. Every term's 128-bit hash votes with its
weight on each bit. The share of equal bits estimates 1 - angle / pi between
the weighted term vectors: about 0.5 for texts with nothing in common.

Search by permuted block tables: fingerprints are cut in B blocks. Two that
differ in at most `radius` bits agree in at least B - radius of them, so with a
table for each choice of B - radius blocks, whose key is those blocks, all of
them meet; B is the least with which the key has more bits than there are
fingerprints to tell apart, so a bucket holds about one by chance. A pair is
given by the first table only in which it meets. Equal fingerprints are one.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common

BITS = 128
DIGITS = BITS // 4
SHINGLE = 5
#: Weights of a word and of a shingle that occur once: even ones tell edited from unrelated texts best, also where texts have few words.
WORD, GRAM = 1, 1
#: The Hamming radius of the search.
RADIUS = 4
#: Ids of the documents that are searched for.
QUERY_STEP = 50

_PLACE = common.odd(SHINGLE, 91)
_LANE = common.odd(BITS // 64, 92)
_KIND = common.odd(2, 93)
#: The bits of each byte, as votes.
_VOTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
_COLUMN = np.arange(BITS // 8) * 256


def _weighed(terms: np.ndarray, weight: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(terms, return_counts=True)
    return common.mix(found * _KIND[kind]), weight * (1 + np.floor(np.log2(n)))


def _voted(terms: np.ndarray, weights: np.ndarray) -> bytes:
    lanes = common.mix(terms[:, None] * _LANE).view(np.uint8)
    if len(terms) < 200:
        ones = weights @ np.unpackbits(lanes, axis=1)
    else:
        sums = np.bincount((lanes + _COLUMN).ravel(), np.repeat(weights, BITS // 8), 256 * (BITS // 8))
        ones = (sums.reshape(-1, 256) @ _VOTES).ravel()
    return np.packbits(2 * ones > weights.sum()).tobytes()


def fingerprints(texts: list[str | None]) -> list[bytes]:
    """16 bytes for each text; all bits are 0 without a word. Texts of fewer than five words have all their words as their one shingle."""
    out: list[bytes] = []
    for a, b in common.chunks(texts):
        words, sizes = common.words(*common.joined(texts[a:b]))
        ends = np.cumsum(sizes)
        for n, end in zip(sizes.tolist(), ends.tolist()):
            if not n:
                out.append(bytes(BITS // 8))
                continue
            w = words[end - n : end]
            k = min(SHINGLE, n)
            grams = sum((w[j : n - k + 1 + j] * _PLACE[j] for j in range(k)), np.zeros(n - k + 1, np.uint64))
            (t1, w1), (t2, w2) = _weighed(w, WORD, 0), _weighed(grams, GRAM, 1)
            out.append(_voted(np.concatenate((t1, t2)), np.concatenate((w1, w2))))
    return out


def likeness(a: Iterable[bytes], b: Iterable[bytes]) -> list[float]:
    """The share of equal bits."""
    return [1 - (int.from_bytes(x) ^ int.from_bytes(y)).bit_count() / BITS for x, y in zip(a, b)]


def edit(text: str, other: str) -> str:
    """text with its last third replaced by the first as many characters of other, or all of them."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


_ROW = "part long, kind string, doc_id long, text string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_TYPES = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in _ROW.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(_NAMES), _TYPES)], names=_NAMES)


def _compared(part: int | None, ids: list, texts: list[str], prints: list[bytes]) -> list[tuple]:
    """Rows of all but the last document, each compared with its edited text and with the document after it."""
    changed = [edit(a, b) for a, b in zip(texts, texts[1:])]
    new = fingerprints(changed)
    rows = zip(ids, texts, changed, prints, new, likeness(prints, new), likeness(prints, prints[1:]))
    return [(part, "done", i, None, len(t), hashlib.sha256(c.encode()).hexdigest(), p.hex(), e.hex(), x, y) for i, t, c, p, e, x, y in rows]


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document, the next one by descending doc_id.

    Documents are dealt out by ranges of doc_id, which shuffles each text once;
    the first and the last of a partition are stored with their texts, and each
    last one is compared with the first of the next partition in a second step.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("salt")]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("salt"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        part, held, empty = TaskContext.get().partitionId(), None, [None] * 5
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if not ids:
                continue
            if held is None:
                yield _batch([(part, "first", ids[0], texts[0], None, *empty)])
            prints = fingerprints(texts)
            if held is not None:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            yield _batch(_compared(part, ids, texts, prints))
            held = ids[-1], texts[-1], prints[-1]
        if held is not None:
            yield _batch([(part, "last", held[0], held[1], None, *empty)])

    out = common.written(rows.mapInArrow(run, _ROW), "simhash-rows")
    parts = sorted(r.part for r in out.filter("kind = 'last'").select("part").collect())  # one number for each partition
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, then long")
    last = out.filter("kind = 'last'").select("part", "doc_id", F.col("text").alias("t")).join(follows, "part")
    last = last.join(out.filter("kind = 'first'").select(F.col("part").alias("then"), F.col("text").alias("u")), "then").select("doc_id", "t", "u")

    def finish(batches):
        for batch in batches:
            rows = []
            for i, t, u in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "t", "u"))):
                rows += _compared(None, [i, None], [t, u], fingerprints([t, u]))
            yield _batch(rows)

    wanted = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return out.filter("kind = 'done'").select(*wanted).union(last.mapInArrow(finish, _ROW).select(*wanted))


# ---------------------------------------------------------------- search


def blocks(n: int, radius: int) -> list[tuple[int, int]]:
    """(start, length) of each block in hexadecimal digits, for n distinct fingerprints."""
    for b in range(radius + 1, DIGITS + 1):
        cuts = [DIGITS * i // b for i in range(b + 1)]
        sizes = [y - x for x, y in zip(cuts, cuts[1:])]
        if 4 * sum(sorted(sizes)[: b - radius]) >= math.log2(n + 1) + 1:
            return list(zip(cuts, sizes))
    raise ValueError(f"no key for {n} fingerprints within {radius} bits")


def _distance(a: str, b: str) -> Column:
    half = lambda c, i: F.conv(F.substring(c, i, 16), 16, -10).cast("long")
    return F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 17).bitwiseXOR(half(b, 17)))


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, cut: list[tuple[int, int]] | None = None) -> DataFrame:
    """query, fingerprint, distance: every pair of a query and a fingerprint (hexadecimal, distinct on each side) within the radius, once.

    cut: the blocks, if they are not to be chosen by the count of fingerprints;
    any choice gives the same pairs.
    """
    cut = cut or blocks(prints.count(), radius)
    tables = list(itertools.combinations(range(len(cut)), len(cut) - radius))
    piece = lambda c, b: F.substring(c, cut[b][0] + 1, cut[b][1])
    keys = lambda c: F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.concat(*[piece(c, b) for b in own]).alias("key")) for t, own in enumerate(tables)]))
    a = queries.select(F.col("fingerprint").alias("query"), keys("fingerprint").alias("x")).select("query", "x.*").alias("a")
    b = prints.select("fingerprint", keys("fingerprint").alias("x")).select("fingerprint", "x.*").alias("b")
    first = F.lit(False)  # in the first table of a pair, no block before the last of the key is equal, but for the key's
    for t, own in enumerate(tables):
        apart = F.lit(True)
        for j in range(own[-1]):
            if j not in own:
                apart = apart & (piece("query", j) != piece("fingerprint", j))
        first = F.when(F.col("a.t") == t, apart).otherwise(first)
    near = (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (_distance("query", "fingerprint") <= radius) & first
    return a.join(b, near).select("query", "fingerprint", _distance("query", "fingerprint").alias("distance"))


def report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of compared(), with near_queries: how many documents with an id divisible by 50 have a fingerprint within the radius (itself, if it is one of them).

    A null text is empty; texts without words have the fingerprint of zeros. A
    null doc_id comes last in the order and is no query. Rows with equal ids
    follow one another by a hash of their texts, and repeated rows are documents
    of their own, of which one is the next of another. The only document is its
    own next one. An empty table gives no rows. A text is held whole by one
    worker, with about 100 bytes for each of its words, and never cut. Other
    columns, of any name, are not looked at.
    """
    common.session(docs.sparkSession)
    rows = common.written(compared(docs), "simhash")
    counts = common.written(rows.groupBy("fingerprint").agg(F.count_if(F.col("doc_id") % QUERY_STEP == 0).alias("asked")), "simhash-prints")
    pairs = search(counts.select("fingerprint"), counts.filter("asked > 0").select("fingerprint"), radius)
    asked = counts.filter("asked > 0").select(F.col("fingerprint").alias("query"), "asked")
    near = pairs.join(asked, "query").groupBy("fingerprint").agg(F.sum("asked").alias("near_queries"))
    return rows.join(near, "fingerprint", "left").select(*rows.columns, F.coalesce("near_queries", F.lit(0)).alias("near_queries"))
