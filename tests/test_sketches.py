"""Merged daily sketches against direct ones and against exact figures."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cluelake.operators import sketches

T0 = datetime(2024, 3, 1)
K = ["kind"]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    data = [(r.choice("ab"), T0 + timedelta(hours=r.randint(0, 239)), r.randint(0, 40_000), r.choice([r.lognormvariate(0, 2), 0.0, -1.0, None]) if i % 9 == 0 else r.lognormvariate(0, 2)) for i in range(60_000)]
    data += [("c", None, 1, 1.0), ("c", T0, None, None)]
    return spark.createDataFrame(data, "kind string, ts timestamp, who long, value double").cache()


@pytest.mark.parametrize("first, last", [("2024-03-02", "2024-03-05"), ("2024-03-01", "2024-03-31")])
def test_merged_equals_direct(spark, rows, first, last):
    stored = sketches.daily(rows, K, "ts", "who", "value")
    merged = sketches.merged(stored, K, first, last)
    inside = rows.filter(F.to_date("ts").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    direct = inside.groupBy("kind").agg(F.hll_sketch_agg("who", F.lit(sketches.LG_K)).alias("h"), F.theta_sketch_agg("who", F.lit(sketches.THETA_LG)).alias("t"), F.count_distinct("who").alias("exact"), F.count("*").alias("n"))
    direct = direct.groupBy("kind", "exact", "n").agg(F.hll_union_agg("h").alias("h"), F.theta_union_agg("t", F.lit(sketches.THETA_LG)).alias("t"))
    got = merged.alias("m").join(direct.alias("d"), "kind").select(
        "kind", "d.exact", F.col("m.n").alias("a"), F.col("d.n").alias("b"), F.hll_sketch_estimate("m.things").alias("c"), F.hll_sketch_estimate("d.h").alias("e"), F.theta_sketch_estimate("m.thing_set").alias("f"), F.theta_sketch_estimate("d.t").alias("g")
    )
    for x in got.collect():
        assert (x.a, x.f) == (x.b, x.g)
        for n in (x.c, x.e):  # their registers are the same, but a direct one's estimate also knows the order of arrival
            assert abs(n - x.exact) <= 4 * 0.8 / math.sqrt(1 << sketches.LG_K) * x.exact + 1


def test_quantiles_of_ranks(rows):
    x = sketches.estimated(sketches.merged(sketches.daily(rows, K, "ts", "who", "value"), K, "2024-03-01", "2024-03-31"), K, (0.1, 0.5, 0.99)).filter("kind <> 'c'")
    for r in x.collect():
        values = sorted(v.value for v in rows.filter((F.col("kind") == r.kind) & F.col("value").isNotNull()).collect())
        for q, v in ((0.1, r.q10), (0.5, r.q50), (0.99, r.q99)):
            below, upto = sum(a < v for a in values), sum(a <= v for a in values)
            assert below - 0.02 * len(values) <= q * len(values) <= upto + 0.02 * len(values)


def test_buckets_are_within_alpha(rows):
    stored = sketches.daily_buckets(rows, K, "ts", "value")
    got = {r.kind: r for r in sketches.bucket_quantiles(stored, K, "2024-03-02", "2024-03-06", (0.01, 0.5, 0.9)).collect()}
    days = rows.filter(F.to_date("ts").between(F.lit("2024-03-02").cast("date"), F.lit("2024-03-06").cast("date")) & F.col("value").isNotNull())
    for kind in "ab":
        values = sorted(v.value for v in days.filter(F.col("kind") == kind).collect())
        assert got[kind].n == len(values)
        for q, v in ((0.01, got[kind].q1), (0.5, got[kind].q50), (0.9, got[kind].q90)):
            true = values[math.ceil(q * len(values)) - 1]
            assert v == 0 if true <= 0 else abs(v - true) <= sketches.ALPHA * true * 1.0001
    assert "c" not in got


def test_sets_and_missing_days(spark):
    x = spark.createDataFrame([("a", T0, i, 1.0) for i in range(50)] + [("a", T0 + timedelta(days=9), i, 1.0) for i in range(30, 90)] + [("b", T0, 1, 1.0), ("z", T0 + timedelta(days=9), 1, None)], "kind string, ts timestamp, who long, value double")
    stored = sketches.daily(x, K, "ts", "who", "value")
    one, two = sketches.merged(stored, K, "2024-03-01", "2024-03-02"), sketches.merged(stored, K, "2024-03-09", "2024-03-12")
    assert sorted(tuple(r) for r in sketches.returning(one, two, K).collect()) == [("a", 20, 30, 40), ("b", 0, 1, 0), ("z", 0, 0, 1)]
    assert sketches.merged(stored, K, "2025-01-01", "2025-01-02").count() == 0
    assert sketches.estimated(sketches.merged(stored, K, "2024-03-09", "2024-03-12"), K, (0.5,)).filter("kind = 'z'").first().n == 1


def test_bitmaps_are_exact(spark):
    """More things than sketches hold, of any sign and size, over parts that only one range has."""
    r = random.Random(5)
    data = [(r.choice("ab"), T0 + timedelta(hours=r.randint(0, 239)), r.choice([r.randint(-50_000, 50_000), 10**12 + r.randint(0, 9)])) for _ in range(60_000)]
    data += [("c", T0, 7), ("c", T0, None), ("d", T0 + timedelta(days=8), 8), ("e", None, 9)]
    sets = sketches.daily_sets(spark.createDataFrame(data, "kind string, ts timestamp, who long"), K, "ts", "who")
    within = lambda kind, first, days: {who for k, t, who in data if k == kind and t and who is not None and T0 + timedelta(days=first) <= t < T0 + timedelta(days=first + days)}
    got = {x.kind: x.n_things for x in sketches.distinct(sets, K, "2024-03-01", "2024-03-06").collect()}
    assert got == {k: len(within(k, 0, 6)) for k in "abc"} and got["a"] > 1 << sketches.THETA_LG
    both = {x.kind: (x.both, x.gone, x.new) for x in sketches.returning_exactly(sets, K, ("2024-03-01", "2024-03-04"), ("2024-03-08", "2024-03-10")).collect()}
    a, b = ({k: within(k, *days) for k in "abcd"} for days in ((0, 4), (7, 3)))
    assert both == {k: (len(a[k] & b[k]), len(a[k] - b[k]), len(b[k] - a[k])) for k in "abcd"}


def _against_sql(spark, tmp_path, name):
    """Rows of a query and of its SQL, over 40,000 users, of whom each has three events."""
    import duckdb

    import __spark_entry__ as entry

    at = "TIMESTAMP '2024-01-01' + to_hours(24 * {} + i::INT % 24)"
    rows = " UNION ALL ".join(f"SELECT 3 * i + {k} AS event_id, {at.format(day)} AS ts, i AS user_id, CASE WHEN i % 4 = 0 THEN 'click' ELSE 'view' END AS event_type, (i % 97)::DOUBLE AS value FROM range(40000) t(i)" for k, day in enumerate(("1", "(2 + i::INT % 5)", "(CASE WHEN i % 3 = 0 THEN 20 ELSE 10 END)")))
    duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    x = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(f'"{c}"' for c in x.columns)} FROM ({entry.oracle_sql()[name]}) q").fetchall()
    return sorted(tuple(r) for r in x.collect()), sorted(want)


@pytest.mark.parametrize("name", ["sketch_ranges", "sketch_returning"])
def test_many_users_are_counted_as_by_sql(spark, tmp_path, name):
    got, want = _against_sql(spark, tmp_path, name)
    assert got == want
