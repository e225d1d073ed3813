"""Operator 8: exact substring deduplication by per-shard suffix arrays.

Bytes of a document go if a LENGTH-byte string covers them that also starts in
a document with a smaller id. Equal strings have to meet in one place without
moving every suffix. Of the GRAM-byte grams inside a string the one of least
hash is its anchor, which depends on nothing but the string; successive
strings of a text mostly have the same anchor. Segments ask which anchors
occur in more than one document, and send only strings of those: for a run of
successive strings with one anchor, the bytes that hold them, a snippet. Equal
snippets of a segment are sent once, with the least id of their documents, so
a passage in very many documents reaches its bucket once from each segment. A
bucket of anchors thus gets all equal strings that can matter, and answers each
segment with the least id of every string.

In a bucket, distinct snippets are put in shards of SHARD bytes. A shard's
suffix array is made by Larsson-Sadakane refinement (sort by 7 symbols, then
double the depth, sorting again only groups that are still equal, until none
is), and common prefixes by Kasai's walk, in lock step over all snippets. Strings of a group
with a common prefix of LENGTH get the least id of their documents. Shards are
merged by binary search of each shard's sorted strings in the others'.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common, segments
from cluelake.llm.segments import Segment

LENGTH, GRAM = 50, 24
WIDTH = LENGTH - GRAM + 1
#: Strings of a run at most; a longer one is cut.
MOST = 64
#: Bytes that a suffix array covers at most (one snippet more).
SHARD = 1_000_000
#: Text bytes for each bucket of snippets.
BUCKET_BYTES = 4_000_000
_M = common.odd(8, 21)
NULL_ID = np.iinfo(np.int64).max


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of successive strings with one anchor: where the first starts, how many, the anchor's hash.

    data: bytes; ends: for each document where it begins, and the last one's end; a separator ends each.
    """
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, np.uint64)
    h = data.astype(np.uint64) + np.uint64(1)
    by = {}
    for k, d in enumerate((1, 2, 4, 8)):
        h = h[:-d] * _M[k] + h[d:]
        by[2 * d] = h
    g = by[16][: len(data) - GRAM + 1] * _M[5] + by[8][16 : 16 + len(data) - GRAM + 1]
    g = common.mix(g)
    m = g
    for d in (1, 2, 4, 8):
        m = np.minimum(m[:-d], m[d:])
    m = np.minimum(m[: -(WIDTH - 16)], m[WIDTH - 16 :])[:n]
    ok = np.ones(n, bool)  # strings that hold no separator
    for e in (ends[1:] - 1).tolist():
        ok[max(0, e - LENGTH + 1) : e + 1] = False
    at = np.flatnonzero(ok)
    if not len(at):
        return none, none, np.zeros(0, np.uint64)
    v = m[at]
    new = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (at[1:] != at[:-1] + 1))))
    k, start, v = np.diff(np.append(new, len(at))), at[new], common.mix(v[new] ^ _M[6])  # least hashes are small; buckets need even ones
    parts = -(-k // MOST)  # periodic text has long runs
    turn = common.spans(parts) * MOST
    return np.repeat(start, parts) + turn, np.minimum(np.repeat(k, parts) - turn, MOST), np.repeat(v, parts)


def _runs(s: Segment):
    """Of a segment: start (in its data), number of strings, anchor, and document of each run."""
    parts = []
    for i, j in s.chunks(50_000):  # arrays that fit in a cache
        a = int(s.starts[i])
        start, k, v = anchors(s.data[a : s.starts[j]], s.starts[i : j + 1] - a)
        parts.append((start + a, k, v))
    start, k, v = (np.concatenate([p[c] for p in parts]) for c in range(3))
    return start, k, v, np.searchsorted(s.starts, start, "right") - 1


def _asked(s: Segment, n: int):
    _, _, v, doc = _runs(s)
    order = np.lexsort((doc, v))
    v, doc = v[order], doc[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (doc[1:] != doc[:-1])
    v, k = segments.distinct(v[keep])
    e = segments.bucket_edges(v, n)
    filled = np.flatnonzero(np.diff(e)).tolist()
    ids = [segments.send(v[e[i] : e[i + 1]]) for i in filled]
    many = [np.packbits(k[e[i] : e[i + 1]] > 1).tobytes() for i in filled]
    yield pa.RecordBatch.from_pydict({"bucket": filled, "seg": [s.seg] * len(filled), "ids": ids, "many": many})


def _answered(table: pa.Table) -> pa.Table:
    """One bit for each anchor asked about: more than one document has it."""
    asked = [segments.receive(x) for x in table.column("ids").to_pylist()]
    n = np.concatenate([1 + np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)) for x, a in zip(table.column("many").to_pylist(), asked)] or [np.zeros(0, np.uint8)])
    ids = np.concatenate(asked)
    order = np.argsort(ids, kind="stable")
    some, k = segments.distinct(ids[order])
    total = np.add.reduceat(n[order].astype(np.int64), np.cumsum(k) - k) if len(some) else np.zeros(0, np.int64)
    out = [np.packbits(total[np.searchsorted(some, x)] > 1).tobytes() for x in asked]
    return pa.table({"seg": table.column("seg"), "bucket": table.column("bucket"), "shared": pa.array(out, pa.binary()), "n": pa.array([len(x) for x in asked], pa.int64())})


class Shared:
    """Of a segment, the runs whose anchor more than one document has, in the order of their buckets, and their distinct snippets.

    which: of each run, the number of its snippet; edges: where each bucket's
    runs begin, and the end; cuts: the same of snippets; raw: the snippets.
    """

    def __init__(self, s: Segment, path: str, n: int):
        start, k, v, doc = _runs(s)
        some, _ = segments.distinct(np.sort(v))
        got = [r for _, r in sorted(segments.answer(path, s.seg).items())]
        shared = np.concatenate([np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=r["n"]) for r in got] or [np.zeros(0, np.uint8)])
        if len(shared) != len(some):
            raise ValueError(f"segment {s.seg} isn't answered in full")
        keep = np.flatnonzero(shared[np.searchsorted(some, v)] == 1)
        bucket = segments.bucket_of(v[keep], n).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keep, bucket = keep[order], bucket[order]
        self.start, self.k = start[keep], k[keep]
        self.value = np.where(s.known, s.ids, NULL_ID)[doc[keep]]
        self.edges = np.searchsorted(bucket, np.arange(n + 1))
        data, seen = s.data.tobytes(), {}  # equal snippets have one anchor, so one bucket
        ends = (self.start + self.k + LENGTH - 1).tolist()
        self.which = np.array([seen.setdefault(data[i:j], len(seen)) for i, j in zip(self.start.tolist(), ends)], np.int64)
        self.raw = list(seen)
        first = np.zeros(len(seen), np.int64)
        first[self.which[::-1]] = np.arange(len(keep))[::-1]
        self.cuts = np.searchsorted(first, self.edges)  # numbers follow the order of first places
        self.least = np.full(len(seen), NULL_ID, np.int64)
        np.minimum.at(self.least, self.which, self.value)


def _snippets(s: Segment, path: str, n: int):
    """A row for each bucket with runs: the sizes (strings) of the segment's distinct snippets, the least ids that have them, and their bytes."""
    x = Shared(s, path, n)
    for b in np.flatnonzero(np.diff(x.cuts)).tolist():
        i, j = int(x.cuts[b]), int(x.cuts[b + 1])
        raw = x.raw[i:j]
        k = np.array([len(r) for r in raw], "<i8") - LENGTH + 1
        yield pa.RecordBatch.from_pydict({"bucket": [b], "seg": [s.seg], "k": [k.astype("<u1").tobytes()], "value": [x.least[i:j].astype("<i8").tobytes()], "data": [b"".join(raw)]})


# ---------------------------------------------------------------- suffix arrays


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Positions of sym (0 ends a snippet, others 1-256) in the order of their suffixes.

    The order is complete: a 0 is less than any other symbol, and of two 0s the
    earlier is less, so no two suffixes are equal and nothing after a snippet's
    end is compared.
    """
    n = len(sym)
    pad = np.concatenate((sym, np.zeros(7, sym.dtype))).astype(np.uint64)
    key, inside = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(7):
        inside &= pad[i : i + n] != 0
        key = key << np.uint64(9) | pad[i : i + n] * inside
    sa = np.argsort(key, kind="stable").astype(np.int32)
    k = key[sa]
    new = np.concatenate(([True], k[1:] != k[:-1])) | ~inside[sa]  # with a 0 at the same place, the order by position is that of the 0s
    del key, k, inside
    rank = np.empty(n, np.int32)
    start = np.flatnonzero(new).astype(np.int32)
    group = np.repeat(start, np.diff(np.append(start, n)))  # a group's rank is the place where it begins
    rank[sa] = group
    h = 7
    while True:
        at = np.flatnonzero(~(new & np.append(new[1:], True)))  # only groups that are still equal; they hold no 0 in h symbols
        if not len(at):
            return sa
        pos = sa[at]
        second = rank[pos + h]
        order = np.lexsort((second, group[at]))
        sa[at] = pos[order]
        second, g = second[order], group[at]
        fresh = np.concatenate(([True], (second[1:] != second[:-1]) | (g[1:] != g[:-1])))
        begin = np.flatnonzero(fresh)
        group[at] = np.repeat(at[begin], np.diff(np.append(begin, len(at))))
        new[at] = fresh
        rank[sa[at]] = group[at]
        h *= 2


def kasai(sym: np.ndarray, sa: np.ndarray, first: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each position with the one before it in sa, up to `most` and the snippet's end.

    Walks all snippets in step: from a position to the next the prefix gets
    shorter by one at most, as the order of sa is complete. `most` bounds what
    is walked again.
    """
    n = len(sym)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    lcp = np.zeros(n, np.int32)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    h = np.zeros(len(first), np.int64)
    longest = int(size[0]) if len(size) else 0
    live = len(first)
    for t in range(longest):
        while live and size[live - 1] <= t:
            live -= 1
        i = first[:live] + t
        j = before[i]
        g = np.maximum(h[:live] - 1, 0)
        run = np.flatnonzero((j >= 0) & (g < most))
        while len(run):
            x = sym[np.minimum(i[run] + g[run], n - 1)]
            y = sym[np.minimum(j[run] + g[run], n - 1)]
            run = run[(x == y) & (x != 0)]
            g[run] += 1
            run = run[g[run] < most]
        g[j < 0] = 0
        lcp[i] = g
        h[:live] = g
    return lcp


def _shard(raw: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a shard's snippets: the group of each string in snippet order, the groups' strings sorted, and their least ids."""
    size = np.array([len(r) for r in raw], np.int64)
    sym = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    first = np.cumsum(size + 1) - size - 1
    sym[first + size] = 0
    sa = suffix_array(sym)
    lcp = kasai(sym, sa, first, size, LENGTH)
    k = size - LENGTH + 1
    at = np.repeat(first, k) + common.spans(k)  # where the strings start
    is_string = np.zeros(len(sym), bool)
    is_string[at] = True
    same = lcp[sa] >= LENGTH
    place = np.flatnonzero(is_string[sa])
    group = np.cumsum(~same)[place]
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    of = np.empty(len(sym), np.int64)
    of[at] = np.repeat(np.arange(len(raw)), k)
    ids = np.minimum.reduceat(least[of[sa[place]]], begin)
    number = np.empty(len(sym), np.int64)
    number[sa[place]] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(place))))
    text = (sym - np.uint16(1)).astype(np.uint8)
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, LENGTH)[sa[place[begin]]]).view(f"S{LENGTH}").ravel()
    return number[at], strings, ids


def _least_ids(raw: list[bytes], least: np.ndarray) -> np.ndarray:
    """For each string of each snippet, in order: the least id of the snippets that hold it."""
    shards, at, n = [], 0, 0
    for i, r in enumerate(raw):
        if n and n + len(r) > SHARD:
            shards.append(_shard(raw[at:i], least[at:i]))
            at, n = i, 0
        n += len(r) + 1
    shards.append(_shard(raw[at:], least[at:]))
    for a in range(len(shards)):  # merge: each pair of shards by binary search
        for b in range(a):
            s, t = shards[a][1], shards[b][1]
            p = np.minimum(np.searchsorted(t, s), len(t) - 1)
            hit = np.flatnonzero(t[p] == s)
            both = np.minimum(shards[a][2][hit], shards[b][2][p[hit]])
            shards[a][2][hit], shards[b][2][p[hit]] = both, both
    for a in range(len(shards) - 1, -1, -1):  # and back, so that a least id found late reaches all
        for b in range(len(shards)):
            if a != b:
                s, t = shards[a][1], shards[b][1]
                p = np.minimum(np.searchsorted(t, s), len(t) - 1)
                hit = np.flatnonzero(t[p] == s)
                shards[b][2][p[hit]] = np.minimum(shards[a][2][hit], shards[b][2][p[hit]])
    return np.concatenate([ids[number] for number, _, ids in shards])


def _found(table: pa.Table) -> pa.Table:
    """For each segment, the least id of each string of its snippets, in order: ids, and how many strings in turn have each (within a snippet)."""
    cols = {c: table.column(c).to_pylist() for c in ("k", "value", "data")}
    sent = [np.frombuffer(x, np.uint8).astype(np.int64) for x in cols["k"]]
    k, value = np.concatenate(sent), np.concatenate([np.frombuffer(x, "<i8") for x in cols["value"]])
    seen: dict[bytes, int] = {}
    which = np.empty(len(k), np.int64)
    at = 0
    for blob, sizes in zip(cols.pop("data"), sent):
        p = 0
        for z in (sizes + LENGTH - 1).tolist():
            which[at] = seen.setdefault(blob[p : p + z], len(seen))
            p += z
            at += 1
    least = np.full(len(seen), NULL_ID, np.int64)
    np.minimum.at(least, which, value)
    per = np.zeros(len(seen), np.int64)
    per[which] = k
    first = np.cumsum(per) - per
    ids = _least_ids(list(seen), least)
    out: dict[str, list] = {"ids": [], "turns": []}
    at = 0
    for n in sent:
        w = which[at : at + len(n)]
        at += len(n)
        x = ids[np.repeat(first[w], n) + common.spans(n)]
        new = np.zeros(len(x), bool)
        new[np.cumsum(n) - n] = True
        new[1:] |= x[1:] != x[:-1]
        begin = np.flatnonzero(new)
        out["ids"].append(x[begin].astype("<i8").tobytes())
        out["turns"].append(np.diff(np.append(begin, len(x))).astype("<u1").tobytes())
    return pa.table({"seg": table.column("seg"), "bucket": table.column("bucket"), "ids": pa.array(out["ids"], pa.binary()), "turns": pa.array(out["turns"], pa.binary())})


def _gone(s: Segment, x: Shared, answers: dict[int, dict]) -> np.ndarray:
    """Which bytes of a segment go."""
    mark = np.zeros(len(s.data) + 1, np.int32)
    size = np.array([len(r) for r in x.raw], np.int64) - LENGTH + 1
    for b in np.flatnonzero(np.diff(x.edges)).tolist():
        r, i, j = answers[b], int(x.cuts[b]), int(x.cuts[b + 1])
        ids = np.repeat(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["turns"], np.uint8))
        first = np.cumsum(size[i:j]) - size[i:j]
        for a in range(int(x.edges[b]), int(x.edges[b + 1]), 50_000):
            runs = slice(a, min(a + 50_000, int(x.edges[b + 1])))
            n, start = x.k[runs], x.start[runs]
            turn = common.spans(n)
            off = ids[np.repeat(first[x.which[runs] - i], n) + turn] < np.repeat(x.value[runs], n)
            at = np.flatnonzero(off)
            if len(at):
                where, of = np.repeat(start, n)[at] + turn[at], np.repeat(np.arange(len(n)), n)[at]
                new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])))
                begin = np.flatnonzero(new)
                np.add.at(mark, where[begin], 1)
                np.add.at(mark, where[np.append(begin[1:], len(at)) - 1] + LENGTH, -1)
    return np.cumsum(mark[:-1]) > 0


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (removed runs), kept (binary: the bytes left, joined) of each row of docs (doc_id, text).

    A null text is empty. A null id counts as greater than all others; rows of
    equal id remove nothing from each other. Matches never cross documents.
    """
    return _run(docs, "kept binary", lambda k: k, pa.binary())


def digest(docs: DataFrame) -> DataFrame:
    """As dedup, with kept_sha256 instead of kept."""
    return _run(docs, "kept_sha256 string", lambda k: hashlib.sha256(k).hexdigest(), pa.string())


def _run(docs: DataFrame, last: str, value, kind) -> DataFrame:
    try:
        return _deduped(docs, last, value, kind)
    finally:
        common.session(docs.sparkSession)


def _deduped(docs: DataFrame, last: str, value, kind) -> DataFrame:
    size = common.text_bytes(docs)
    seg = segments.pack(docs, F.lit(0), separator=0)
    n_segments = seg.count()
    n = segments.n_buckets(size, 14.0)
    asked = segments.each(seg, lambda s: _asked(s, n), "bucket long, seg long, ids binary, many binary")
    path = segments.keep_answers(segments.by_bucket(asked, _answered, "seg long, bucket long, shared binary, n long"), n_segments)
    m = common.parts(size, BUCKET_BYTES)
    sent = segments.each(seg, lambda s: _snippets(s, path, m), "bucket long, seg long, k binary, value binary, data binary")
    found = segments.keep_answers(segments.by_bucket(sent, _found, "seg long, bucket long, ids binary, turns binary"), n_segments)

    def apply(s: Segment):
        off = _gone(s, Shared(s, path, m), segments.answer(found, s.seg))
        begins = off & np.concatenate(([True], ~off[:-1]))
        size = np.diff(s.starts) - 1
        count = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[s.starts])
        removed, spans = count(off), count(begins)
        kept = [value(s.data[a:b][~off[a:b]].tobytes()) for a, b in zip(s.starts[:-1].tolist(), (s.starts[1:] - 1).tolist())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", last.split()[0]]
        yield pa.RecordBatch.from_arrays([s.id_array(), pa.array(size), pa.array(removed), pa.array(spans), pa.array(kept, kind)], names=names)

    return common.written(segments.each(seg, apply, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}"), "deduped")


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
p AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50) x),
m AS (SELECT s, min(doc_id) AS least FROM p GROUP BY s),
bad AS (SELECT p.doc_id, p.i FROM p JOIN m ON m.s = p.s WHERE m.least < p.doc_id),
mark AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM bad),
num AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM mark),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM num GROUP BY doc_id, k),
gap AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM span),
cut AS (SELECT g.doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last, string_agg(substring(h, 2 * f + 1, 2 * (a - f)), '' ORDER BY a) AS kept FROM gap g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END)) AS kept_sha256 FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""
