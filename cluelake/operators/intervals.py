"""Joins of points with intervals, and of intervals with one another, where the equal keys are few or there are none.

A join on keys and a range alone puts all of a key in one task, and each of its
points beside each of its intervals. Here both sides are cut in bins: an
interval goes to the bins that it covers, a point to its own, and they meet by
an equi-join on (keys, level, bin). Long intervals go to a coarser level, where
they cover at most FAN + 1 bins. Bins with more than `most` points are split:
their points are dealt to so many parts by a hash of the row, their intervals
go to each. A pair meets in one bin and one part only, so nothing has to be made distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.functions.timing import FILLERS

#: How much wider each level's bins are than the last's.
FAN = 16
#: Points of a bin that are kept together.
MOST = 20_000
#: Bins that are broadcast at most; beyond, Spark joins them as it likes.
BROADCAST_BINS = 50_000


def _level(length: Column, width: float) -> Column:
    """The least level at which an interval covers at most FAN + 1 bins."""
    return F.greatest(F.lit(0), F.ceil(F.log(length / (width * FAN)) / F.log(F.lit(float(FAN))))).cast("int")


def _bin(at: Column, level: Column, width: float) -> Column:
    return F.floor(at / (F.pow(F.lit(float(FAN)), level) * width))


def _levels(x: DataFrame) -> list[int]:
    """The levels in use: a handful, as each is FAN times the last."""
    return [r[0] for r in x.select("_level").distinct().collect() if r[0] is not None]


def _split(bins: DataFrame, on: list[str], most: int) -> DataFrame:
    """Bins with more than `most` rows, with the parts that they are dealt to."""
    hot = bins.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*on, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    return F.broadcast(hot) if hot.limit(BROADCAST_BINS + 1).count() <= BROADCAST_BINS else hot


def _meet(points: DataFrame, spans: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, list[str]]:
    """Both sides by (keys, _level, _bin, _part), joined."""
    on = [*keys, "_level", "_bin"]
    hot = _split(points, on, most)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = F.pmod(F.xxhash64(*points.columns), parts).cast("int")  # not at random: a task that runs again deals as before
    a = points.join(hot, on, "left").withColumn("_part", dealt).drop("_parts")
    b = spans.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return a.join(b, [*on, "_part"]), [*on, "_part"]


def within(points: DataFrame, spans: DataFrame, keys: list[str], at: str, lo: str, hi: str, width: float, most: int = MOST) -> DataFrame:
    """Pairs of a point and a span of equal keys (or of none) with lo <= at <= hi; columns of both, whose other names differ.

    width: about the length of a common span. Rows with a null key, place or
    bound, and spans that end before they begin, meet nothing.
    """
    s = spans.filter(F.col(lo) <= F.col(hi)).withColumn("_level", _level(F.col(hi) - F.col(lo), width))
    s = s.withColumn("_bin", F.explode(F.sequence(_bin(F.col(lo), F.col("_level"), width), _bin(F.col(hi), F.col("_level"), width))))
    levels = _levels(s)
    if not levels:
        return points.join(spans.filter("false"), keys) if keys else points.crossJoin(spans.filter("false"))
    p = points.filter(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    p = p.withColumn("_bin", _bin(F.col(at), F.col("_level"), width))
    x, own = _meet(p, s, keys, most)
    return x.filter(F.col(at).between(F.col(lo), F.col(hi))).drop(*[c for c in own if c not in keys])


def overlapping(a: DataFrame, b: DataFrame, keys: list[str], a_bounds: tuple[str, str], b_bounds: tuple[str, str], width: float, most: int = MOST) -> DataFrame:
    """Pairs of half-open intervals [lo, hi) of both sides that overlap, of equal keys; columns of both, whose other names differ.

    Two intervals overlap where the later start lies in the other one, so each
    pair is one of a start of a in b, or of a start of b strictly within a:
    two joins of points with intervals, without a pair twice. Empty intervals
    overlap nothing.
    """
    (al, ah), (bl, bh) = a_bounds, b_bounds
    a, b = a.filter(F.col(al) < F.col(ah)), b.filter(F.col(bl) < F.col(bh))
    one = within(a, b, keys, al, bl, bh, width, most).filter(F.col(al) < F.col(bh))
    two = within(b, a, keys, bl, al, ah, width, most).filter((F.col(bl) < F.col(ah)) & (F.col(bl) > F.col(al)))
    return one.unionByName(two)


def acoustics(buzzes: DataFrame, words: DataFrame, keys: list[str], width: float, most: int = MOST) -> DataFrame:
    """As timing.acoustics(), however many words a key has: sums are made in each part of a bin before buzzes are put together."""
    filler = F.regexp_replace(F.lower("word"), r"^[,.?!]+|[,.?!]+$", "").isin(*FILLERS)
    w = words.select(*keys, F.col("start").alias("_start"), F.col("end").alias("_end"), "prob", filler.alias("_filler"))
    x = within(w, buzzes.select(*keys, "t0", "t1").distinct(), keys, "_start", "t0", "t1", width, most).filter(F.col("_end") <= F.col("t1"))
    sums = x.groupBy(*keys, "t0", "t1").agg(F.bround(F.avg("prob"), 4).alias("confidence"), F.count_if("_filler").alias("disfluencies"))
    out = buzzes.select(*keys, "t0", "t1").distinct().join(sums, [*keys, "t0", "t1"], "left")
    return out.select(*keys, "t0", "t1", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("disfluencies", F.lit(0)).alias("disfluencies"))


def segments_around(anchors: DataFrame, segments: DataFrame, before: int, after: int) -> DataFrame:
    """As transcript.in_range(), for episodes of any length: segments within [at - before, at + after] of each anchor (episode, at)."""
    s = segments.select("episode", "pos", "speaker", "text", "start_ms", "end_ms")
    a = anchors.withColumns({"_lo": F.col("at") - before, "_hi": F.col("at") + after})
    return within(s, a, ["episode"], "pos", "_lo", "_hi", float(before + after + 1)).select(*anchors.columns, *[c for c in s.columns if c != "episode"])
