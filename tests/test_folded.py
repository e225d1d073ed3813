"""Tables kept by a stream: replays, crashes before a commit, and equality with the full computation."""

import random

import pytest
from pyspark.sql import functions as F

from cluelake.streaming import folded

STEPS = "id long, seq long, status string, stage string, ms double"


def made(spark, seed, n):
    r = random.Random(seed)
    return spark.createDataFrame([(r.randint(0, 20), r.randint(0, 10**6), r.choice(["A", "B", "C"]), r.choice(["x", "y", None]), r.choice([1.0, 2.5, None])) for _ in range(n)], STEPS)


def test_board_equals_the_full_query_after_replays(spark, tmp_path):
    log = folded.opened(spark, f"file://{tmp_path}", folded.BOARD, snapshot_every=4)
    sink, whole = folded.board_sink(log), None
    for i in range(5):
        batch = made(spark, i, 30 if i != 3 else 0)
        sink(batch, i)
        sink(batch, i)
        if i:
            sink(batch, i - 1)  # an older number is known, too
        whole = batch if whole is None else whole.union(batch)
    counts, stages = folded.board(log)
    want = whole.groupBy("id").agg(F.max(F.struct("seq", "status")).alias("s")).groupBy("s.status").count()
    assert sorted(tuple(r) for r in counts.collect()) == sorted(tuple(r) for r in want.collect())
    times = whole.filter("stage IS NOT NULL").groupBy("stage").agg(F.count("ms").alias("n"), F.avg("ms").alias("m"))
    assert sorted(tuple(r) for r in stages.collect()) == sorted(tuple(r) for r in times.collect())


def test_a_crash_before_the_commit_leaves_nothing(spark, tmp_path):
    log = folded.opened(spark, f"file://{tmp_path}", folded.BOARD)
    bad = made(spark, 1, 5).withColumn("ms", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        folded.board_sink(log)(bad, 0)
    assert log.version() == 1 and log.state("latest").count() == 0
    folded.board_sink(log)(made(spark, 1, 5), 0)
    assert log.version() == 2
    assert folded.opened(spark, f"file://{tmp_path}", folded.BOARD).state("batches").first().batch == 0  # a restart finds it


def test_gate(spark, tmp_path):
    log = folded.opened(spark, f"file://{tmp_path}", folded.GATE)
    sink = folded.gate_sink(log)
    rows = lambda *x: spark.createDataFrame(list(x), "id long, attempt long, n_clues long, weight double")
    sink(rows((1, 0, 60, 3.0), (2, 0, 44, 0.0), (3, 0, 60, 3.5), (4, 0, None, None)), 0)
    sink(rows((2, 1, 45, 0.5), (3, 1, 60, 9.0)), 1)
    for b in (2, 3, 3):
        sink(rows((3, b, 60, 9.0)), b)
    queue = {r.id: (r.status, r.retry_count) for r in log.state("queue").collect()}
    assert queue == {1: ("COMPLETED", 0), 2: ("COMPLETED", 1), 3: ("FAILED", 3), 4: ("TRANSCRIPT_READY", 1)}
    assert sorted(r.id for r in log.state("accepted").collect()) == [1, 2]
    assert sorted((r.id, r.attempt) for r in log.state("quarantined").collect()) == [(2, 0), (3, 0), (3, 1), (3, 2), (3, 3), (4, 0)]
    assert log.state("queue").filter("id = 3").first().last_error == "Quality gate: weight 9.0, 60 clues"
