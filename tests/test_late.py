"""Late rows, replayed batches, closed windows and buckets."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cluelake.sources import commit
from cluelake.streaming import dedup, late, live, windows

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, kind string, value double"


def batch(spark, *rows):
    return spark.createDataFrame([(None if h is None else T0 + timedelta(hours=h), k, v) for h, k, v in rows], SCHEMA)


def files(spark, path, parts):
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"file://{path}/{i}")
        commit.touched(spark, f"file://{path}/{i}", 1_000_000_000_000 + 1000 * i)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{path}")


def test_policy(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    sink = late.policy(out, "1 hour", "2 hours", ["kind"])
    batches = [
        batch(spark, (0.1, "a", 1.0), (5.5, "a", 2.0)),
        batch(spark, (3.2, "a", 4.0), (2.9, "a", 8.0), (3.5, "b", None), (None, "a", 16.0)),  # watermark 3.5: the window 3-4 is open, 2-3 closed
        batch(spark, (0.2, "c", 32.0)),  # the watermark doesn't go back
        batch(spark, (9.0, "a", 64.0)),
    ]
    for i, b in enumerate(batches):
        sink(b, i)
        sink(b, i)  # a replayed batch
    w = {(r.w_start.hour, r.kind): (r.n, r.total) for r in late.windows(spark, out, ["kind"]).collect()}
    assert w == {(0, "a"): (1, 1.0), (5, "a"): (1, 2.0), (3, "a"): (1, 4.0), (3, "b"): (1, None), (9, "a"): (1, 64.0)}
    missed = sorted((r.value, r.batch, r.watermark) for r in late.late_rows(spark, out).collect())
    mark = T0 + timedelta(hours=3.5)
    assert missed == [(8.0, 1, mark), (16.0, 1, mark), (32.0, 2, mark)]
    sink(batch(spark).limit(0), 4)  # an empty batch carries the mark on
    sink(batch(spark, (6.5, "a", 1.0)), 5)
    assert late.late_rows(spark, out).filter("batch = 5").first().watermark == T0 + timedelta(hours=7)


def test_policy_agrees_with_windows_that_spark_closes(spark, tmp_path):
    parts = [batch(spark, (0.5, "a", 1.0), (8.0, "a", 2.0)), batch(spark, (9.0, "a", 3.0)), batch(spark, (10.0, "a", 4.0), (0.6, "a", 50.0)), batch(spark, (40.0, "a", 5.0))]
    stream = files(spark, tmp_path / "in", parts)
    out, native = f"file://{tmp_path}/out", f"file://{tmp_path}/native"
    live.run_to_end(stream, late.policy(out, "1 hour", "2 hours", ["kind"]), f"file://{tmp_path}/at1")
    q = live.run_to_end(windows.tumbling(stream, "1 hour", ["kind"], late="2 hours"), commit.stream_sink(native, lambda x: {"rows": x}), f"file://{tmp_path}/at2", "append")
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) == late.late_rows(spark, out).count() == 1
    closed = {(r.w_start, r.n, r.total) for r in commit.read_table(spark, native, "rows").collect()}
    mine = {(r.w_start, r.n, r.total) for r in late.windows(spark, out, ["kind"]).collect()}
    assert closed < mine and len(mine - closed) == 1  # the window of the last event is still open


def test_interval_join_gives_out_the_unmatched_and_drops_state(spark, tmp_path):
    left = [batch(spark, (1.0, "a", 1.0), (2.0, "b", 2.0)), batch(spark, (3.0, "a", 3.0)), batch(spark, (99.0, "z", 0.0))]
    right = [batch(spark, (0.5, "a", 10.0), (1.0, "a", 11.0), (1.1, "a", 12.0)), batch(spark, (1.9, "a", 13.0)), batch(spark, (99.0, "z", 0.0))]
    x = late.interval_join(files(spark, tmp_path / "l", left), files(spark, tmp_path / "r", right), ["kind"], "1 HOUR", "1 hour")
    q = live.run_to_end(x, commit.stream_sink(f"file://{tmp_path}/out", lambda d: {"rows": d}), f"file://{tmp_path}/at", "append")
    got = sorted((r.value, r.r_value or 0) for r in commit.read_table(spark, f"file://{tmp_path}/out", "rows").filter("kind <> 'z'").collect())
    assert got == [(1.0, 10.0), (1.0, 11.0), (2.0, 0), (3.0, 0)]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


HEARD = "episode long, seq long, round string, category string, start_ms double, n_attempts long, text string, started timestamp"


def heard(spark, *rows):
    return spark.createDataFrame([(e, seq, "J!", cat, float(ms), n, text, T0) for e, seq, cat, ms, n, text in rows], HEARD)


def test_best_of_bucket(spark, tmp_path):
    parts = [
        heard(spark, (1, 1, "Cat", 1000.5, 1, "x"), (1, 2, " cat ", 2900, 3, "y"), (2, 1, "Cat", 2000, None, None)),
        heard(spark, (1, 3, "CAT", 2500, 3, "longer"), (1, 4, "Cat", 2600, 3, "longer"), (1, 5, "Dog", 2000, 0, "d")),
        heard(spark, (9, 9, "z", 900_000, 1, "z")),
        heard(spark, (9, 11, "z", 900_000, 0, "z")),  # the watermark of a batch is known to the next one
        heard(spark, (1, 6, "Cat", 2000, 99, "far too late"), (9, 10, "z", 901_500, 0, "z")),
    ]
    q = live.run_to_end(dedup.best_of_bucket(files(spark, tmp_path / "in", parts), "5 seconds"), commit.stream_sink(f"file://{tmp_path}/out", lambda d: {"rows": d}), f"file://{tmp_path}/at", "append")
    got = {(r.episode, r.category.strip().lower()): (r.seq, r.n_attempts, r.text, r.first_seq) for r in commit.read_table(spark, f"file://{tmp_path}/out", "rows").collect()}
    assert got == {(1, "cat"): (3, 3, "longer", 1), (1, "dog"): (5, 0, "d", 5), (2, "cat"): (1, 0, None, 1)}
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2  # only open buckets are held


def test_first_of(spark, tmp_path):
    x = files(spark, tmp_path / "in", [batch(spark, (1, "a", 1.0)), batch(spark, (1, "a", 2.0), (2, "b", 3.0)), batch(spark, (50, "c", 0.0)), batch(spark, (50, "c", 0.0)), batch(spark, (51, "a", 5.0))])
    live.run_to_end(dedup.first_of(x, ["kind"], "3 hours"), commit.stream_sink(f"file://{tmp_path}/out", lambda d: {"rows": d}), f"file://{tmp_path}/at", "append")
    assert sorted(r.value for r in commit.read_table(spark, f"file://{tmp_path}/out", "rows").filter(F.col("kind") != "c").collect()) == [1.0, 3.0, 5.0]
