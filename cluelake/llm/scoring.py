"""Operator 9: language-model scores by deleted interpolation.

p(w | h) mixes the maximum-likelihood estimates of orders ORDER to 1 (of the
bigram, c(v w) / c(v), of the unigram, c(w) / N) and the uniform 1 / (V + 1).
The weights depend on the bucket of the longest context's count: 0, 1, 2-3,
4-7, ... They are learned by expectation maximisation on held-out counts: each
training token in turn is held out, so that its counts are less by one
(deleted estimation). All training tokens take part. They are gathered in a
table of cells, by bucket and by half octaves of the estimates, whose size
doesn't depend on the corpus; a cell has the sums of its estimates, and their
means stand for them. Only that comes to the driver. Counts cover the whole
training part; nothing is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common, segments
from cluelake.llm.segments import Segment

CONTEXTS, BINS = 48, 96
#: Longest n-gram.
ORDER = 2
FOLDS, HELD_OUT = 7, 2
ROUNDS = 60
#: Least weight of the uniform part.
FLOOR = 1e-6
#: n-gram ids that a bucket answers.
BUCKET = 400_000
END = np.uint64(0xE5D0E5D0E5D0E5D1)
BEGIN = np.uint64(0xB2E61B2E61B2E615)
_A, _B, _C = common.odd(3, 99)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


class Tokens:
    """A segment's tokens, with an end after each document: n (tokens of each), grams (ids of the n-grams of orders 1, 2 ... that end in each token)."""

    def __init__(self, s: Segment, order: int):
        found = []
        counts = np.zeros(len(s.ids), np.int64)
        for i, j in s.chunks():
            h, n = common.words(common.LOWER[s.data[s.starts[i] : s.starts[j]]], s.starts[i : j + 1] - s.starts[i])
            found.append(h)
            counts[i:j] = n
        words = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.n = counts + 1
        self.ends = np.cumsum(self.n)
        self.first = self.ends - self.n
        own = np.empty(len(words) + len(counts), np.uint64)
        is_end = np.zeros(len(own), bool)
        is_end[self.ends - 1] = True
        own[is_end], own[~is_end] = END, words
        del words, found, is_end
        self.train = s.extra != HELD_OUT
        self.train_token = np.repeat(self.train, self.n)
        self.grams = [common.mix(own * _A)]
        for k in range(2, order + 1):  # an n-gram is the shorter one that ends in the token before, and a token
            self.grams.append(common.mix(own * _B + self.before(self.grams[-1], BEGIN + np.uint64(k)) * _C))

    def before(self, x: np.ndarray, start) -> np.ndarray:
        """x of the token before; start for a document's first."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.first] = start
        return out


def _asked(s: Segment, n: int, order: int) -> pa.RecordBatch:
    """A row for each bucket: distinct ids of the segment's unigrams and longer n-grams, and how often each occurs in its training part."""
    t = Tokens(s, order)
    cols: dict[str, list] = {"bucket": [*range(n)], "seg": [s.seg] * n}
    for name, grams in (("uni", t.grams[:1]), ("more", t.grams[1:])):
        all_ = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        count = np.zeros(len(all_), "<u4")
        for g in grams:
            some, k = segments.distinct(np.sort(g[t.train_token]))
            count[np.searchsorted(all_, some)] += k.astype("<u4")
        e = segments.bucket_edges(all_, n)
        cols[name] = [segments.send(all_[a:b]) for a, b in zip(e, e[1:])]
        cols[f"{name}_n"] = [count[a:b].tobytes() for a, b in zip(e, e[1:])]
    filled = [i for i in range(n) if cols["uni"][i] or cols["more"][i]]
    return pa.RecordBatch.from_pydict({k: [v[i] for i in filled] for k, v in cols.items()})


def _answered(table: pa.Table) -> pa.Table:
    """Sums over all segments that ask a bucket; its first row has N and V of the bucket's unigrams."""
    out: dict[str, list] = {"seg": table.column("seg").to_pylist(), "bucket": table.column("bucket").to_pylist()}
    rest = [0] * (table.num_rows - 1)
    for name in ("uni", "more"):
        asked = [segments.receive(x.as_py()) for x in table.column(name)]
        size = [len(x) for x in asked]
        ids = np.concatenate(asked)
        del asked
        count = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column(f"{name}_n")])
        some, at = np.unique(ids, return_inverse=True)
        del ids
        total = np.bincount(at, count, len(some)).astype("<u8")  # exact: under 2^53
        if name == "uni":
            out["tokens"], out["types"] = [int(total.sum()), *rest], [int((total > 0).sum()), *rest]
        cut = np.concatenate(([0], np.cumsum(size)))
        out[f"{name}_n"] = [total[at[a:b]].tobytes() for a, b in zip(cut, cut[1:])]
    return pa.table({k: out[k] for k in ("seg", "bucket", "tokens", "types", "uni_n", "more_n")})


def _context(c: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 + floor(log2 c)."""
    return np.where(c > 0, 1 + np.floor(np.log2(np.maximum(c, 1))), 0).astype(np.int64).clip(0, CONTEXTS - 1)


class Counts:
    """Corpus counts of a segment's tokens: of the n-grams of each order that end there (order 1 first), and of those n-grams' contexts."""

    def __init__(self, s: Segment, path: str, order: int, n_tokens: int, n_docs: int):
        self.t = t = Tokens(s, order)
        got = [r for _, r in sorted(segments.answer(path, s.seg).items())]
        self.own = []
        for name, grams in (("uni", t.grams[:1]), ("more", t.grams[1:])):
            if grams:
                all_ = np.unique(np.concatenate(grams))
                n = np.concatenate([np.frombuffer(r[f"{name}_n"], "<u8") for r in got] or [np.zeros(0, "<u8")]).astype(np.int64)
                if len(n) != len(all_):
                    raise ValueError(f"segment {s.seg} isn't answered in full")
                self.own += [n[np.searchsorted(all_, g)] for g in grams]
        t.grams = []
        # a context is the shorter n-gram that ends in the token before; every training document begins once
        self.context = [np.full(len(t.train_token), n_tokens), *(t.before(c, n_docs) for c in self.own[:-1])]

    def estimates(self, less: int = 0) -> Iterator[np.ndarray]:
        """The maximum-likelihood estimates of each order, the longest first; less: what is taken from all counts."""
        for c, ctx in zip(self.own[::-1], self.context[::-1]):
            yield np.where(ctx > less, (c - less) / np.maximum(ctx - less, 1), 0.0)


def _bin(p: np.ndarray) -> np.ndarray:
    """Half octaves below 1, the last but one for all that is less; the last is 0."""
    return np.where(p > 0, np.round(-2 * np.log2(np.maximum(p, 1e-300))).clip(0, BINS - 2), BINS - 1).astype(np.int64)


def weights(bucket: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each context bucket, the weights of p's columns (the longest order first, the uniform part last) by expectation maximisation over held-out rows."""
    k = p.shape[1]
    out = np.tile([*[0.8 / (k - 1)] * (k - 1), 0.2], (CONTEXTS, 1))
    for b in np.unique(bucket):
        x, n, w = p[bucket == b], counts[bucket == b].astype(float), out[b]
        for _ in range(ROUNDS):
            part = x * w
            part *= (n / part.sum(1))[:, None]
            w = part.sum(0) / n.sum()
            w[-1] = max(w[-1], FLOOR)
            w /= w.sum()
        out[b] = w
    if k > 2:  # after a context never seen there is nothing of the longest order
        out[0, 0] = 0
        out[0] /= max(out[0].sum(), 1e-12)
    return out


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs (doc_id, text).

    A null or empty text has one token, its end. A null id is the empty text
    where folds are told apart. Without training documents only the uniform
    part is left; an empty table gives an empty one. Repeated rows count, and
    are scored, as often as they occur. A very long text is a segment of its
    own and takes some 30 times its bytes in a worker. Other columns of docs
    are left out, whatever their names.
    """
    try:
        return _scores(docs, order)
    finally:
        common.session(docs.sparkSession)  # Arrow batches as before


def _scores(docs: DataFrame, order: int) -> DataFrame:
    n = common.parts(common.text_bytes(docs) * order / 36, BUCKET)  # an n-gram of each order for each word, half of them distinct
    n_docs = docs.filter(fold(F.col("doc_id")) != HELD_OUT).count()
    seg = segments.pack(docs, fold(F.col("doc_id")))
    asked = segments.each(seg, lambda s: iter([_asked(s, n, order)]), "bucket long, seg long, uni binary, uni_n binary, more binary, more_n binary")
    answers = common.written(segments.by_bucket(asked, _answered, "seg long, bucket long, tokens long, types long, uni_n binary, more_n binary"), "ngram-counts")
    total = answers.agg(F.sum("tokens"), F.sum("types")).first()
    n_tokens, n_types = total[0] or 0, total[1] or 0
    path = segments.keep_answers(answers.select("seg", "bucket", "uni_n", "more_n"), seg.count())
    uniform = 1.0 / (n_types + 1)
    sums = [f"p{k}" for k in range(order)]

    def held(s: Segment):
        c = Counts(s, path, order, n_tokens, n_docs)
        keep = c.t.train_token
        cell, p = _context(c.context[-1][keep] - 1) if order > 1 else np.zeros(int(keep.sum()), np.int64), []
        for x in c.estimates(1):
            p.append(x[keep])
            cell = cell * BINS + _bin(p[-1])
        k, at = np.unique(cell, return_inverse=True)
        rows = {"cell": pa.array(k, pa.int64()), "n": pa.array(np.bincount(at, minlength=len(k)), pa.int64())}
        yield pa.RecordBatch.from_pydict(rows | {c: pa.array(np.bincount(at, x, len(k)), pa.float64()) for c, x in zip(sums, p)})

    cells = segments.each(seg, held, f"cell long, n long, {', '.join(f'{c} double' for c in sums)}")
    table = cells.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums]).toPandas()  # CONTEXTS * BINS^order rows at most
    count = table["n"].to_numpy(np.int64)
    p = np.column_stack([*(table[c].to_numpy(float) / np.maximum(count, 1) for c in sums), np.full(len(table), uniform)])
    w = weights(table["cell"].to_numpy(np.int64) // BINS**order, p, count)

    def scored(s: Segment):
        c = Counts(s, path, order, n_tokens, n_docs)
        t = c.t
        b = _context(c.context[-1]) if order > 1 else np.zeros(len(t.train_token), np.int64)
        add = lambda x: np.add.reduceat(x, t.first)
        p = w[b, order] * uniform
        for k, x in enumerate(c.estimates()):
            p += w[b, k] * x
        base = add(np.log10((c.own[0] + 1) / (n_tokens + 1 * (n_types + 1))))
        yield pa.RecordBatch.from_arrays(
            [s.id_array(), pa.array(~t.train), pa.array(t.n), pa.array(add((c.own[0] > 0).astype(np.int64))), pa.array([n_tokens] * len(t.n), pa.int64()), pa.array(base), pa.array(add(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return common.written(segments.each(seg, scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "scores")
