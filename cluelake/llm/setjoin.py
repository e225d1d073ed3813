"""Operator 3: exact n-gram Jaccard self-join by a partition of the universe, and its groups.

A document's set holds 64-bit hashes of its 5-word shingles; two sets link at
J = |a & b| / |a | b| >= 0.75. Sets are put in size bands. For a band whose
largest set has U hashes, the hash space is cut in m ranges ("segments"). Two
linked sets of sizes s <= r differ in at most (r + s) / 7 hashes, so they
agree in all but as many segments (pigeonhole). A set sends the hash of every
segment that isn't empty, to its own band and to the band below if a partner
can be there. Bands of small sets have half as many segments, and send each
also with one hash deleted: then two sets that differ by one hash in a segment
meet as well. m comes from the cost: the least number with which sets of U
hashes have enough filled segments.

A segment shared by more than GROUP sets (a passage in many documents, a large
group of near copies) is not used. A set that loses so many segments, or has
so many empty ones, that the pigeonhole no longer holds is *deficient*. A pair
with one set that isn't deficient shares a segment that is used. Pairs of two
deficient sets are found by their rarest hashes: counted among deficient sets,
in the first |a| - ceil(0.75 |a|) + 1 of each by rising count, linked sets
share one. No group's pairs are all formed: each set is compared with the
group's pivot first. Then, of groups by segments (of GROUP sets at most), sets
still in different components are compared. Groups by rare hashes may be of any
size; they are taken apart by the hashes in which sets differ from their pivot
(see _recentred). Candidates are compared by a bound first (the parity of how
many hashes fall on each of some bits), then exactly, on all hashes. Nothing is
dropped or capped; equal sets are one set throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cluelake.llm import common, segments
from cluelake.llm.components import components
from cluelake.llm.segments import Segment

WORDS = 5
#: J >= PERCENT / 100
PERCENT = 75
#: Sets that share a segment at most, for the segment to be used; all pairs of such a group are candidates.
GROUP = 24
#: Segments as a part of a band's largest size, and the largest size of bands with deletions.
FILL, DELETE = 0.39, 8
#: Segment hashes that a bucket takes.
BUCKET = 1_500_000
#: Text bytes whose sets a worker holds at once.
CHUNK = 1_000_000
NO_ROLE = 1 << 30
PAIR, MEMBER = -1, -2


def _bands() -> np.ndarray:
    """Least sizes of the bands."""
    edges = [1, 2, 3, 4, 6, 9]
    while edges[-1] < 1 << 40:
        edges.append(int(edges[-1] * 1.6))
    return np.array(edges, np.int64)


EDGES = _bands()
UPPER = EDGES[1:] - 1
_DELETES = UPPER <= DELETE
#: Segments of each band; none where only equal sets link.
PIECES = np.where(UPPER < 3, 0, np.where(_DELETES, (UPPER // 3 + 2) // 2, np.ceil(FILL * UPPER).astype(np.int64) + 2))
_C = common.odd(16, 7)


class Sets:
    """Shingle sets of a segment's documents: hashes sorted within each, how many, where each begins, and the set's own hash."""

    def __init__(self, s: Segment):
        hashes, sizes = [], np.zeros(len(s.ids), np.int64)
        for i, j in s.chunks():
            w, n = common.words(common.LOWER[s.data[s.starts[i] : s.starts[j]]], s.starts[i : j + 1] - s.starts[i])
            h, k = _shingles(w, n)
            hashes.append(h)
            sizes[i:j] = k
        self.h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.n = sizes
        self.first = np.cumsum(sizes) - sizes
        self.value = common.mix(self.h ^ _C[0])
        total = np.zeros(len(sizes), np.uint64)
        some = sizes > 0
        if some.any():
            total[some] = np.add.reduceat(self.value, self.first[some])
        self.fp = common.mix(total + sizes.astype(np.uint64) * _C[1]).view(np.int64)


    def parity(self, i: int) -> bytes:
        """How many hashes fall on each bit, modulo 2, of the least power of two of bits that isn't under the size."""
        n = int(self.n[i])
        bits = 1 << max(6, (n - 1).bit_length())
        at = self.h[self.first[i] : self.first[i] + n] & np.uint64(bits - 1)
        return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def _parity_apart(a: bytes, b: bytes) -> int:
    """A lower bound of the hashes in which two sets differ; the longer parity is folded to the shorter."""
    x, y, n, m = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(a), len(b)
    while n > m:
        n //= 2
        x = (x >> 8 * n) ^ (x & (1 << 8 * n) - 1)
    while m > n:
        m //= 2
        y = (y >> 8 * m) ^ (y & (1 << 8 * m) - 1)
    return (x ^ y).bit_count()


def _shingles(w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(n) - n
    k = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    at = np.repeat(starts, k) + common.spans(k)
    size = np.repeat(np.minimum(n, WORDS), k)
    h = size.astype(np.uint64) * _C[2]
    for d in range(WORDS):
        x = w[np.minimum(at + d, max(len(w) - 1, 0))] * _C[3 + d]
        x[d >= size] = 0
        h += x
    h = common.mix(h)
    ends = np.cumsum(k)
    for a, b in zip((ends - k)[k > 1].tolist(), ends[k > 1].tolist()):
        h[a:b].sort()
    doc = np.repeat(np.arange(len(n)), k)
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.bincount(doc[keep], minlength=len(n))


def _roles(x: Sets):
    """For own band and band below: hash, document, and margin (segments that a document may lose) of every segment sent."""
    own = np.searchsorted(EDGES, x.n, "right") - 1
    below = np.searchsorted(EDGES, -(-x.n * PERCENT // 100), "right") - 1
    for role, band in ((0, own), (1, np.where((below < own) & (x.n > 0), own - 1, -1))):
        used = (band >= 0) & (x.n > 0)
        m = np.where(used, PIECES[np.maximum(band, 0)], 0)
        margin = np.full(len(x.n), NO_ROLE, np.int64)
        docs = np.flatnonzero(m > 0)
        if not len(docs):
            yield role, np.zeros(0, np.uint64), np.zeros(0, np.int64), margin
            continue
        size = x.n[docs]
        at = np.repeat(x.first[docs], size) + common.spans(size)
        h, v, doc = x.h[at], x.value[at], np.repeat(docs, size)
        piece = ((h >> np.uint64(32)) * m[doc].astype(np.uint64)) >> np.uint64(32)
        run = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1]))))
        length = np.diff(np.append(run, len(h)))
        total = np.add.reduceat(v, run)
        of = doc[run]
        where = (band[of].astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _C[9] + piece[run] * _C[10]
        sig = common.mix(total ^ common.mix(where.copy()))
        small = _DELETES[band[of]]
        # one hash deleted from each segment of two or more
        r = np.repeat(np.arange(len(run)), length)
        cut = small[r] & (length[r] > 1)
        r = r[cut]
        less = common.mix((total[r] - v[cut]) ^ common.mix(where[r]))
        good = np.bincount(of[~small | (length > 1)], minlength=len(x.n))
        most = x.n // 3 if role == 0 else (x.n + UPPER[np.maximum(band, 0)]) // 7
        need = np.where(_DELETES[np.maximum(band, 0)], most // 2, most)
        margin[docs] = (good - need - 1)[docs]
        yield role, np.append(sig, less), np.append(of, of[r]), margin


def _described(s: Segment):
    for i, j in s.chunks(CHUNK):
        yield _described_part(s.part(i, j), i)


def _described_part(s: Segment, first: int) -> pa.RecordBatch:
    x = Sets(s)
    margins = {role: margin for role, _, _, margin in _roles(x)}
    return pa.RecordBatch.from_arrays(
        [s.id_array(), pa.array(x.n), pa.array(x.fp), pa.array([s.seg] * len(x.n), pa.int64()), pa.array(first + np.arange(len(x.n))), pa.array(margins[0]), pa.array(margins[1]), pa.array([x.parity(i) if k else b"" for i, k in enumerate(x.n.tolist())], pa.binary())],
        names=["doc_id", "n", "fp", "seg", "at", "margin0", "margin1", "parity"],
    )


def _sent(s: Segment, n: int):
    """Rows for buckets: sets (their hash), role and number of the segments that follow, 4 bytes each."""
    for i, j in s.chunks(CHUNK):
        yield _sent_part(s.part(i, j), n)


def _sent_part(s: Segment, n: int) -> pa.RecordBatch:
    x = Sets(s)
    once = np.zeros(len(x.n), bool)
    once[np.unique(x.fp, return_index=True)[1]] = True
    sets = [[] for _ in range(n)]
    counts = [[] for _ in range(n)]
    sigs = [[] for _ in range(n)]
    for role, sig, doc, _ in _roles(x):
        sig, doc = sig[once[doc]], doc[once[doc]]
        bucket = (((sig >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)).astype(np.int64)
        order = np.argsort(bucket * len(x.n) + doc, kind="stable")
        sig, doc, bucket = sig[order].astype("<u4"), doc[order], bucket[order]
        e = np.searchsorted(bucket, np.arange(n + 1))
        for b in range(n):
            d, k = segments.distinct(doc[e[b] : e[b + 1]])
            sets[b].append(x.fp[d].astype("<i8").tobytes())
            counts[b].append((k * 2 + role).astype("<u4").tobytes())
            sigs[b].append(sig[e[b] : e[b + 1]].tobytes())
    filled = [b for b in range(n) if any(sigs[b])]
    join = lambda v: [b"".join(v[b]) for b in filled]
    return pa.RecordBatch.from_pydict({"bucket": filled, "sets": join(sets), "counts": join(counts), "sigs": join(sigs)})


def _met(table: pa.Table) -> pa.Table:
    """Rows of three kinds by role.

    PAIR: a set and the pivot a of a segment that both have. MEMBER: a group a
    of three sets or more that share a segment, and one of them. 0, 1: how many
    segments of a set, as sent in this role, too many sets share (b).
    """
    get = lambda c, t: np.concatenate([np.frombuffer(v, t) for v in table.column(c).to_pylist()])
    sets, counts, sig = get("sets", "<i8"), get("counts", "<u4").astype(np.int64), get("sigs", "<u4")
    of = np.repeat(np.arange(len(sets)), counts >> 1)
    order = np.argsort(sig, kind="stable")
    sig, of = sig[order], of[order]
    _, k = segments.distinct(sig)
    many = np.repeat(k > 1, k)  # of a lone one nothing comes
    sig, node, role = sig[many], sets[of[many]], (counts & 1)[of[many]]
    order = np.lexsort((node, sig))
    sig, node, role = sig[order], node[order], role[order]
    keep = np.ones(len(sig), bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node, role = sig[keep], node[keep], role[keep]
    _, k = segments.distinct(sig)
    start = np.cumsum(k) - k
    # one of equal groups: near copies share segment after segment
    group = np.add.reduceat(common.mix(node.view(np.uint64).copy()), start) if len(k) else np.zeros(0, np.uint64)
    group = common.mix(group ^ k.astype(np.uint64)).view(np.int64)
    small = np.flatnonzero((k > 1) & (k <= GROUP))
    small = small[np.unique(group[small], return_index=True)[1]]
    size = k[small]
    pivot, rest = node[start[small]], size - 1
    other = node[np.repeat(start[small] + 1, rest) + common.spans(rest)]
    pairs = np.unique(np.stack([np.repeat(pivot, rest), other], 1), axis=0)
    small, size = small[size > 2], size[size > 2]
    member = node[np.repeat(start[small], size) + common.spans(size)]
    hot = np.repeat(k > GROUP, k)
    lost, n = np.unique(np.stack([node[hot], role[hot]], 1), axis=0, return_counts=True)
    out = (pairs[:, 0], np.repeat(group[small], size), lost[:, 0]), (pairs[:, 1], member, n), (np.full(len(pairs), PAIR), np.full(len(member), MEMBER), lost[:, 1])
    return pa.table({c: np.concatenate(v).astype(np.int64) for c, v in zip(("a", "b", "role"), out)})


def _fetched(seg: DataFrame, wanted: DataFrame, n_segments: int) -> DataFrame:
    """fp, set (array of long) of wanted sets (fp, seg, at: one place of each)."""
    lists = wanted.groupBy("seg", F.floor(F.col("at") / 4096).alias("bucket")).agg(F.collect_list("at").alias("ats"))
    path = segments.keep_answers(lists, n_segments)
    seg.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # segments again

    def run(s: Segment):
        ats = sorted(i for r in segments.answer(path, s.seg).values() for i in r["ats"])
        for i in range(0, len(ats), 256):
            x = Sets(s.only(ats[i : i + 256]))
            yield pa.RecordBatch.from_pydict({"fp": x.fp, "set": pa.array([x.h[a : a + n].view(np.int64) for a, n in zip(x.first.tolist(), x.n.tolist())], pa.list_(pa.int64()))})

    out = common.written_alone(segments.each(seg, run, "fp long, set array<long>"), "sets")
    common.session(seg.sparkSession)
    return out


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    x = pairs.join(sets.select(F.col("fp").alias("a"), F.col("set").alias("s")), "a").join(sets.select(F.col("fp").alias("b"), F.col("set").alias("t")), "b")
    both = F.size(F.array_intersect("s", "t"))
    return x.filter(100 * both >= PERCENT * (F.size("s") + F.size("t") - both)).select("a", "b")


def _plausible(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs that may link by their sizes and by the parity of their hashes, which never excludes a link."""
    one = lambda c: sizes.select(F.col("fp").alias(c), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))
    x = pairs.join(one("a"), "a").join(one("b"), "b").filter(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))

    def run(batches):
        for t in batches:
            n = [i + j for i, j in zip(t.column("na").to_pylist(), t.column("nb").to_pylist())]
            # linked sets differ in at most (100 - PERCENT) / (100 + PERCENT) of their sizes' sum
            keep = [_parity_apart(p, q) * (100 + PERCENT) <= (100 - PERCENT) * k for p, q, k in zip(t.column("pa").to_pylist(), t.column("pb").to_pylist(), n)]
            yield t.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return x.mapInArrow(run, "a long, b long")


def _ranked(each: DataFrame, group: list[str], size) -> DataFrame:
    """For each hash h that sets (fp) of a group share, its place in the order by rarity of every set with it.

    Hashes that only this set has, `alone` of them, come first. Of two sets that
    share k hashes or more, each has one in common with the other in the first
    size - k + 1.
    """
    known = each.groupBy(*group, "h").agg(F.count("*").alias("k")).filter("k > 1")
    each = each.join(known, [*group, "h"])
    w = Window.partitionBy(*group, "fp")
    each = each.withColumn("alone", size - F.count("*").over(w))
    return each.withColumn("place", F.col("alone") + F.row_number().over(w.orderBy("k", "h")))


def _rare_groups(sets: DataFrame) -> DataFrame:
    """h, fp, alone: the sets that share each hash among their rarest ones."""
    each = sets.select("fp", F.size("set").alias("n"), F.explode("set").alias("h"))
    # a linked set has PERCENT of the hashes at least; exact, as n * PERCENT is a whole number
    least = F.ceil(F.col("n") * PERCENT / 100)
    return _ranked(each, [], F.col("n")).filter(F.col("place") <= F.col("n") - least + 1).select("h", "fp", "alone")


def _stars(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """p, fp, m, n, linked, apart: each set compared with the pivot p of its groups, the set with the fewest hashes of its own.

    Of near copies that is the nearest to their common source. m, n: sizes; apart: the hashes that only one of both has.
    """
    pivot = groups.groupBy("h").agg(F.min(F.struct("alone", "fp")).alias("p")).select("h", F.col("p.fp").alias("p"))
    pairs = common.written_alone(groups.join(pivot, "h").filter("fp != p").select("p", "fp").distinct(), "star-pairs")
    one = lambda c, v: sets.select(F.col("fp").alias(c), F.col("set").alias(v))
    x = pairs.join(one("p", "s"), "p").join(one("fp", "t"), "fp")
    x = x.select("p", "fp", F.size("s").alias("m"), F.size("t").alias("n"), F.concat(F.array_except("s", "t"), F.array_except("t", "s")).alias("apart"))
    linked = F.size("apart") * (100 + PERCENT) <= (100 - PERCENT) * (F.col("m") + F.col("n"))
    return common.written_alone(x.withColumn("linked", linked), "stars")


def _with_component(rows: DataFrame, comp: DataFrame) -> DataFrame:
    return rows.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def _recentred(stars: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Small groups (h, fp, component, near) with every pair of sets of a star that may link and isn't in one component yet.

    Seen from the pivot, |a ^ b| = |A| + |B| - 2 |A & B|, where A and B are the
    hashes in which a and b differ from it. So linked sets share
    (|A| + |B| - (a + b) / 7) / 2 of these differences or more (sevenths at 75
    percent). Sets linked with the pivot are in one component with it. If one
    of both sets isn't, that number is over 0, and groups by the rarest
    differences have the pair: near copies of a source share most hashes, but
    hardly the changes made to each. In the first groups, all pairs count; in
    the second, those of one set that is linked with the pivot (near) and one
    that isn't, which may share less.
    """
    rows = _with_component(stars, comp)
    open_ = rows.groupBy("p").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("linked").alias("all")).filter("x < y AND NOT all").select("p")
    d, c = 100 + PERCENT, 100 - PERCENT
    far = d * F.size("apart") - c * F.col("n")
    least = lambda x: F.ceil(x / (2 * d))
    rows = rows.join(open_, "p", "left_semi").select("p", "fp", "component", F.col("linked").alias("near"), F.size("apart").alias("size"), least(far + c * F.col("m") + 1).alias("with_far"), least(far - c * F.col("m")).alias("with_near"), F.explode("apart").alias("h"))
    x = _ranked(rows, ["p"], F.col("size"))
    up_to = lambda k: F.col("place") <= F.col("size") - F.col(k) + 1
    x = x.withColumn("short", up_to("with_far")).filter(F.col("short") | (~F.col("near") & up_to("with_near")))
    x = common.written_alone(x.select(F.xxhash64("p", "h").alias("h"), "fp", "component", "near", "short"), "recentred")
    return x.filter("short").drop("short"), x.filter("near OR NOT short").drop("short")


def _across(g: DataFrame, two: DataFrame) -> DataFrame:
    """Pairs of a group of g in different components: sets outside the group's main component with all others of the group; of two: near with others."""
    parts = g.groupBy("h", "component").agg(F.count("*").alias("k"))
    main = parts.groupBy("h").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    g = g.join(main.select("h", "main"), "h")
    left = g.filter("component != main").select("h", F.col("fp").alias("a"), F.col("component").alias("ca"))
    right = g.select("h", F.col("fp").alias("b"), F.col("component").alias("cb"), (F.col("component") == F.col("main")).alias("is_main"))
    x = left.join(right, "h").filter((F.col("ca") != F.col("cb")) & (F.col("is_main") | (F.col("a") < F.col("b")))).select("a", "b")
    side = lambda near, c: two.filter("near" if near else "NOT near").select("h", F.col("fp").alias(c), F.col("component").alias(f"c{c}"))
    y = side(True, "a").join(side(False, "b"), "h").filter("ca != cb").select("a", "b")
    return x.union(y).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links lead to) of each row of docs (doc_id, text).

    Null, empty and blank texts have no shingles and link with nothing. Rows
    of equal id are rows of their own. A null id counts as greater than all.
    """
    try:
        return _groups(docs)
    finally:
        common.session(docs.sparkSession)


def _groups(docs: DataFrame) -> DataFrame:
    size = common.text_bytes(docs)
    seg = segments.pack(docs, F.lit(0))
    n_segments = seg.count()
    described = common.written_alone(segments.each(seg, _described, "doc_id long, n long, fp long, seg long, at long, margin0 long, margin1 long, parity binary"), "described")
    n = common.parts(size / 8, BUCKET)  # about 0.7 segment hashes for each word of 6 bytes
    sent = segments.each(seg, lambda s: _sent(s, n), "bucket long, sets binary, counts binary, sigs binary")
    met = common.written_alone(segments.by_bucket(sent, _met, "a long, b long, role long"), "met")
    sizes = common.written_alone(described.filter("n > 0").groupBy("fp").agg(F.min("n").alias("n"), F.min("margin0").alias("margin0"), F.min("margin1").alias("margin1"), F.min(F.struct("seg", "at", "parity")).alias("w")).select("fp", "n", "margin0", "margin1", "w.seg", "w.at", "w.parity"), "distinct-sets")
    common.session(docs.sparkSession)
    pairs = met.filter(F.col("role") == PAIR).select("a", "b").distinct()
    shared = met.filter(F.col("role") == MEMBER).select(F.col("a").alias("h"), F.col("b").alias("fp")).distinct()
    lost = met.filter("role >= 0").groupBy(F.col("a").alias("fp")).agg(*[F.sum(F.when(F.col("role") == r, F.col("b"))).alias(f"lost{r}") for r in (0, 1)])
    deficient = sizes.join(lost, "fp", "left").filter("coalesce(lost0, 0) > margin0 OR coalesce(lost1, 0) > margin1").select("fp")
    deficient = common.written_alone(deficient, "deficient")
    pairs = common.written_alone(_plausible(pairs, sizes), "pairs")
    fetched = lambda of: _fetched(seg, of.distinct().join(sizes, "fp").select("fp", "seg", "at"), n_segments)
    ends = lambda p: p.select(F.col("a").alias("fp")).union(p.select("b"))
    sets = fetched(ends(pairs).union(deficient))
    rare = common.written_alone(_rare_groups(sets.join(deficient, "fp", "left_semi")), "rare")
    links = common.written_alone(_linked(pairs, sets), "links")
    stars = _stars(rare, sets)
    links = common.written_alone(links.union(stars.filter("linked").select(F.least("fp", "p").alias("a"), F.greatest("fp", "p").alias("b"))).distinct(), "links")
    comp = components(links)
    fringe, two = _recentred(stars, comp)
    shared = common.written_alone(_with_component(shared, comp), "shared").withColumn("near", F.lit(True))
    pairs = common.written_alone(_plausible(_across(fringe.unionByName(shared), two), sizes), "pairs")
    more = common.written_alone(_linked(pairs, fetched(ends(pairs))), "links")
    if not more.isEmpty():
        comp = components(links.union(more))
    node = described.filter("n > 0").join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").select("doc_id", "n", F.coalesce("component", "fp").alias("c"))
    least_id = node.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    out = node.join(least_id, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(described.filter("n = 0").select("doc_id", "n", "doc_id"))


def representatives(docs: DataFrame, stored: bool = False) -> DataFrame:
    """One row of docs for each group of linked sets: that of the least doc_id (nulls last); rows without shingles stay. Columns stay.

    stored: docs is a table as read from files, so no copy of it is needed to number its rows.
    """
    cols = docs.columns
    rows = common.numbered_rows(docs, stored)
    name, text = f"d{cols.index('doc_id')}", f"d{cols.index('text')}"
    g = groups(rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text"))).select(F.col("doc_id").alias("row"), "component_id")
    g = g.join(rows.select("row", F.col(name).alias("id")), "row")
    first = g.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("w"), F.count("*").alias("n")).filter("n > 1")
    gone = g.join(first, "component_id").filter("row != w.row").select("row")
    return rows.join(common.written_alone(gone, "copies"), "row", "left_anti").select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(cols)])


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
c AS (SELECT x, min(y) AS c FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id
"""
