"""Binned interval joins against all pairs, hot bins, and the operators that they stand in for."""

import random

import pytest
from pyspark.sql import functions as F

from cluelake.functions import timing
from cluelake.operators import intervals, transcript


def spans(r, n, keys):
    out = []
    for i in range(n):
        lo = r.choice([r.uniform(-50, 50), float(r.randint(-5, 5) * 4), 0.0])
        out.append((r.choice(keys), i, lo, lo + r.choice([0.0, 0.5, 4.0, 64.0, 900.0, -1.0, r.uniform(0, 3000)])))
    return [*out, (1, n, None, 3.0), (1, n + 1, 3.0, None), (None, n + 2, -9.0, 9.0)]


@pytest.mark.parametrize("width, most", [(4.0, 3), (0.7, 10_000), (500.0, 5)])
def test_within(spark, width, most):
    r = random.Random(most)
    s = spans(r, 60, [1, 2])
    p = [(r.choice([1, 1, 1, 2]), i, r.choice([r.uniform(-60, 60), float(r.randint(-5, 5) * 4), 0.0])) for i in range(150)] + [(1, 900, None), (None, 901, 1.0)]
    sd = spark.createDataFrame(s, "k int, s int, lo double, hi double").repartition(3)
    pd = spark.createDataFrame(p, "k int, p int, at double").repartition(3)
    got = sorted((x.p, x.s) for x in intervals.within(pd, sd, ["k"], "at", "lo", "hi", width, most).collect())
    assert got == sorted((b, i) for k, i, lo, hi in s for j, b, at in p if None not in (k, lo, hi, at) and j == k and lo <= at <= hi)
    anywhere = sorted((x.p, x.s) for x in intervals.within(pd.drop("k"), sd.drop("k"), [], "at", "lo", "hi", width, most).collect())
    assert anywhere == sorted((b, i) for _, i, lo, hi in s for _, b, at in p if None not in (lo, hi, at) and lo <= at <= hi)
    assert intervals.within(pd, sd.filter("false"), ["k"], "at", "lo", "hi", width).count() == 0
    assert intervals.within(pd.filter("false"), sd, ["k"], "at", "lo", "hi", width).count() == 0


@pytest.mark.parametrize("most", [2, 10_000])
def test_overlapping(spark, most):
    r = random.Random(3)
    a, b = spans(r, 40, [1, 2]), spans(r, 40, [1])
    ad, bd = (spark.createDataFrame(x, f"k int, {n} int, {n}_lo double, {n}_hi double") for x, n in ((a, "a"), (b, "b")))
    got = sorted((x.a, x.b) for x in intervals.overlapping(ad, bd, ["k"], ("a_lo", "a_hi"), ("b_lo", "b_hi"), 8.0, most).collect())
    ok = lambda x: None not in x and x[2] < x[3]
    assert got == sorted((x[1], y[1]) for x in a for y in b if ok(x) and ok(y) and x[0] == y[0] and x[2] < y[3] and y[2] < x[3])


def test_one_key_holds_all_and_no_task_a_tenth(spark):
    """100,000 words of one episode, all in one bin: parts of at most `most` words meet the buzzes in tasks of their own."""
    words = spark.range(100_000).select(F.lit(1).alias("episode"), (F.col("id") % 1000 / 1000).alias("at"), "id")
    buzzes = spark.range(20).select(F.lit(1).alias("episode"), (F.col("id") / 40).alias("lo"), F.lit(1.0).alias("hi"), F.col("id").alias("b"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        x = intervals.within(words, buzzes, ["episode"], "at", "lo", "hi", 10.0, most=1000).withColumn("task", F.spark_partition_id())
        n = [r["count"] for r in x.groupBy("task").count().collect()]
        assert sum(n) == sum(100 * sum(w / 1000 >= b / 40 for w in range(1000)) for b in range(20))
        assert max(n) < sum(n) / 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_stands_in_for_the_joins_by_key(spark):
    r = random.Random(5)
    words = spark.createDataFrame([(e, r.choice(["Um,", "uh", "who", "what"]), t, t + 1.0, r.randint(0, 8) / 8) for e in (1, 2) for t in map(float, range(80))], "episode int, word string, start double, end double, prob double")
    buzzes = spark.createDataFrame([(e, float(t), float(t + n)) for e in (1, 2, 3) for t, n in ((0, 0), (3, 20), (70, 50), (79, 1))], "episode int, t0 double, t1 double")
    key = lambda df: sorted(tuple(x) for x in df.select("episode", "t0", "t1", "confidence", "disfluencies").collect())
    assert key(intervals.acoustics(buzzes, words, ["episode"], 20.0, most=10)) == key(timing.acoustics(buzzes, words, ["episode"]))
    seg = spark.createDataFrame([("e", i, "S", f"t{i}", 0.0, 1.0) for i in range(30)], "episode string, pos long, speaker string, text string, start_ms double, end_ms double")
    at = spark.createDataFrame([("e", 0), ("e", 17), ("x", 3)], "episode string, at long")
    rows = lambda df: sorted((x.at, x.pos, x.text) for x in df.collect())
    assert rows(intervals.segments_around(at, seg, 3, 8)) == rows(transcript.in_range(at, seg, 3, 8))
