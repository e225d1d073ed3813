"""Stored sketches by key and day, merged for any range of days: distinct counts, set operations, quantiles.

A day's sketches are made once and are of a bounded size, whatever the day's
rows; a range merges as many rows as it has days. HyperLogLog for distinct
counts (relative standard error 0.8 / sqrt(2**LG_K)), theta for unions,
intersections and differences of what ranges hold (merged and direct ones give
the same figure), KLL for quantiles of ranks
(error about 1.33 % at K = 200), and log-scaled buckets for quantiles of values
with a relative error of ALPHA, whose merge is a sum and so exact. Where things
are numbers and an estimate won't do, a day also has bitmaps, of 4 KB for each
32,768 numbers that occur, which give the exact counts of any range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LG_K = 14
THETA_LG = 13
K = 200
ALPHA = 0.01
_GAMMA = (1 + ALPHA) / (1 - ALPHA)


def daily(rows: DataFrame, keys: list[str], time: str, thing: str, value: str) -> DataFrame:
    """keys, day, n, things (HLL), thing_set (theta), ranks (KLL) of each key's day. Null things and values are left out of their sketches; rows without a time are left out."""
    x = rows.filter(F.col(time).isNotNull()).groupBy(*keys, F.to_date(time).alias("day"))
    return x.agg(
        F.count("*").alias("n"), F.hll_sketch_agg(thing, F.lit(LG_K)).alias("things"), F.theta_sketch_agg(thing, F.lit(THETA_LG)).alias("thing_set"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(K)).alias("ranks"),
    )


def _between(stored: DataFrame, first, last) -> DataFrame:
    return stored.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def merged(stored: DataFrame, keys: list[str], first, last) -> DataFrame:
    """keys, n, things, thing_set, ranks of the days first .. last, both included; keys without a row then have none."""
    x = _between(stored, first, last).groupBy(*keys)
    return x.agg(F.sum("n").alias("n"), F.hll_union_agg("things").alias("things"), F.theta_union_agg("thing_set", F.lit(THETA_LG)).alias("thing_set"), F.kll_merge_agg_double("ranks", F.lit(K)).alias("ranks"))


def estimated(x: DataFrame, keys: list[str], quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """keys, n, n_things, and a column q50, q90 .. for each quantile of merged sketches."""
    some = F.kll_sketch_get_n_double("ranks") > 0
    return x.select(*keys, "n", F.hll_sketch_estimate("things").alias("n_things"), *[F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"q{round(100 * q)}") for q in quantiles])


def returning(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, both, gone, new: about how many things of two merged ranges are in both, in the first only, in the second only."""
    a, b = (x.select(*keys, F.col("thing_set").alias(n)) for x, n in ((before, "a"), (after, "b")))
    none = F.theta_difference("a", "a")
    x = a.join(b, keys, "full_outer")
    x = x.withColumns({"a": F.coalesce("a", F.theta_difference("b", "b")), "b": F.coalesce("b", none)})
    n = F.theta_sketch_estimate
    return x.select(*keys, n(F.theta_intersection("a", "b")).alias("both"), n(F.theta_difference("a", "b")).alias("gone"), n(F.theta_difference("b", "a")).alias("new"))


# ---------------------------------------------------------------- bitmaps of numbers


def daily_sets(rows: DataFrame, keys: list[str], time: str, thing: str) -> DataFrame:
    """keys, day, part, members: a bitmap of a part of the numbers (thing: whole, any sign) that a key's day has."""
    n = F.col(thing).cast("long")
    x = rows.filter(F.col(time).isNotNull() & n.isNotNull()).groupBy(*keys, F.to_date(time).alias("day"), F.bitmap_bucket_number(n).alias("part"))
    return x.agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("members"))


def distinct(sets: DataFrame, keys: list[str], first, last) -> DataFrame:
    """keys, n_things: exactly how many numbers the days first .. last have."""
    x = _between(sets, first, last).groupBy(*keys, "part").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("n"))
    return x.groupBy(*keys).agg(F.sum("n").alias("n_things"))


def returning_exactly(sets: DataFrame, keys: list[str], before: tuple, after: tuple) -> DataFrame:
    """As returning(), exactly, of two ranges (first, last) of days: keys, both, gone, new."""
    within = lambda r: F.col("day").between(F.lit(r[0]).cast("date"), F.lit(r[1]).cast("date"))
    count = lambda c: F.bitmap_count(F.bitmap_or_agg(c))  # noqa: E731  of nulls alone: 0
    one = sets.filter(within(before) | within(after)).groupBy(*keys, "part")
    one = one.agg(*[count(F.when(within(r), F.col("members"))).alias(c) for r, c in ((before, "a"), (after, "b"))], count("members").alias("either"))
    return one.groupBy(*keys).agg(F.sum(F.col("a") + F.col("b") - F.col("either")).alias("both"), F.sum(F.col("either") - F.col("b")).alias("gone"), F.sum(F.col("either") - F.col("a")).alias("new"))


# ---------------------------------------------------------------- buckets of values


def bucket(value: Column) -> Column:
    """The number of a positive value's bucket; values of one bucket differ by a factor of at most (1 + ALPHA) / (1 - ALPHA). Values of 0 and less share the lowest."""
    return F.when(value > 0, F.ceil(F.ln(value) / math.log(_GAMMA)).cast("int")).when(value.isNotNull(), F.lit(-(1 << 31)))


def daily_buckets(rows: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """keys, day, bucket, n of the values that aren't null."""
    x = rows.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    return x.groupBy(*keys, F.to_date(time).alias("day"), bucket(F.col(value)).alias("bucket")).agg(F.count("*").alias("n"))


def bucket_quantiles(stored: DataFrame, keys: list[str], first, last, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """keys, n and a column for each quantile: the least value of rank ceil(q * n), within ALPHA of it."""
    x = _between(stored, first, last).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys).orderBy("bucket")  # a few thousand buckets at most, whatever the rows
    x = x.withColumns({"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy(*keys))})
    middle = F.when(F.col("bucket") == -(1 << 31), 0.0).otherwise(2 * F.pow(F.lit(_GAMMA), F.col("bucket")) / (_GAMMA + 1))
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(q * F.col("all")), F.struct("bucket", middle.alias("v"))))["v"].alias(f"q{round(100 * q)}")
    return x.groupBy(*keys).agg(F.max("all").alias("n"), *[at(q) for q in quantiles])
