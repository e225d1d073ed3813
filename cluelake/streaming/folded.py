"""Tables that a stream keeps up to date, each batch once: its changes and its number are one commit of a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cluelake.operators.rules import LEAST_CLUES, MOST_WEIGHT
from cluelake.sources.log import Changes, CommitLog
from cluelake.streaming.queue import ERROR_CHARS, MAX_RETRIES

State = Callable[[str], DataFrame]


def once(log: CommitLog, stream: str, change: Callable[[DataFrame, State, int], Changes]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: commits what change makes of a batch and of the tables, together with the batch's number.

    A batch that is replayed after a crash finds its number and changes nothing;
    one that crashed before its commit left nothing that a reader sees.
    """

    def sink(df: DataFrame, batch: int) -> None:
        done = df.sparkSession.createDataFrame([(stream, batch)], "stream string, batch long")

        def step(state: State) -> Changes | None:
            if not state("batches").filter((F.col("stream") == stream) & (F.col("batch") >= batch)).isEmpty():
                return None
            return change(df, state, batch) | {"batches": done}

        log.transact(step, f"{stream} {batch}")

    return sink


def opened(spark: SparkSession, folder: str, tables: dict[str, tuple[list[str], str]], snapshot_every: int = 20) -> CommitLog:
    """A log with empty tables, of which name, keys and schema are given, if it is new; and with the table of batches."""
    tables = tables | {"batches": (["stream"], "stream string, batch long")}
    log = CommitLog(spark, folder, {t: keys for t, (keys, _) in tables.items()}, snapshot_every)
    if log.version() == 0:
        log.commit(0, {t: spark.createDataFrame([], schema) for t, (_, schema) in tables.items()}, "new")
    return log


# ---------------------------------------------------------------- a dashboard

#: What the dashboard reads: the last status of each id, how many ids have each status, and the time that each stage took.
BOARD = {"latest": (["id"], "id long, status string, seq long"), "counts": (["status"], "status string, n long"), "stages": (["stage"], "stage string, runs long, total_ms double")}


def _board(steps: DataFrame, state: State, batch: int) -> Changes:
    """Changes by a batch of steps (id, seq, status, stage, ms): only ids and statuses that it touches are read and written."""
    new = steps.groupBy("id").agg(F.max(F.struct("seq", "status")).alias("s")).select("id", "s.status", "s.seq")
    before = state("latest").select("id", F.col("status").alias("old"), F.col("seq").alias("old_seq"))
    moved = new.join(before, "id", "left").filter(F.col("old_seq").isNull() | (F.col("seq") > F.col("old_seq")))  # a step that comes late changes no status
    delta = moved.select(F.col("status"), F.lit(1).cast("long").alias("d")).union(moved.filter("old IS NOT NULL").select(F.col("old"), F.lit(-1).cast("long")))
    delta = delta.groupBy("status").agg(F.sum("d").alias("d")).filter("d <> 0")
    counts = delta.join(state("counts"), "status", "left").select("status", (F.coalesce("n", F.lit(0)) + F.col("d")).alias("n"))
    took = steps.filter("stage IS NOT NULL").groupBy("stage").agg(F.count("ms").alias("r"), F.sum("ms").alias("t"))
    stages = took.join(state("stages"), "stage", "left").select("stage", (F.coalesce("runs", F.lit(0)) + F.col("r")).alias("runs"), (F.coalesce("total_ms", F.lit(0.0)) + F.coalesce("t", F.lit(0.0))).alias("total_ms"))
    return {"latest": moved.select("id", "status", "seq"), "counts": counts, "stages": stages}


def board_sink(log: CommitLog) -> Callable[[DataFrame, int], None]:
    return once(log, "board", _board)


def board(log: CommitLog) -> tuple[DataFrame, DataFrame]:
    """(status, n; stage, runs, mean_ms): what the dashboard shows, a few rows, whatever the stream has brought."""
    stages = log.state("stages").select("stage", "runs", F.when(F.col("runs") > 0, F.col("total_ms") / F.col("runs")).alias("mean_ms"))
    return log.state("counts").filter("n <> 0"), stages


# ---------------------------------------------------------------- the quality gate

#: Episodes that passed, every extraction that didn't, and where each episode stands.
GATE = {
    "accepted": (["id"], "id long, attempt long, n_clues long, weight double"), "quarantined": (["id", "attempt"], "id long, attempt long, n_clues long, weight double"),
    "queue": (["id"], "id long, status string, retry_count int, last_error string"),
}


def _gate(found: DataFrame, state: State, batch: int) -> Changes:
    """Changes by a batch of extractions (id, attempt, n_clues, weight): accepted, or kept aside and sent back to be extracted anew, at the last retry given up."""
    x = found.groupBy("id").agg(F.max_by(F.struct("attempt", "n_clues", "weight"), "attempt").alias("r")).select("id", "r.*")
    good = (F.col("n_clues") >= LEAST_CLUES) & (F.col("weight") <= MOST_WEIGHT)
    x = x.withColumn("good", F.coalesce(good, F.lit(False))).join(state("queue").select("id", "retry_count"), "id", "left").withColumn("retry_count", F.coalesce("retry_count", F.lit(0)))
    dead = F.col("retry_count") >= MAX_RETRIES
    status = F.when(F.col("good"), "COMPLETED").when(dead, "FAILED").otherwise("TRANSCRIPT_READY")
    retries = F.when(F.col("good") | dead, F.col("retry_count")).otherwise(F.col("retry_count") + 1)
    why = F.substring(F.format_string("Quality gate: weight %.1f, %d clues", "weight", "n_clues"), 1, ERROR_CHARS)
    rows = ["id", "attempt", "n_clues", "weight"]
    queue = x.select("id", status.alias("status"), retries.cast("int").alias("retry_count"), F.when(~F.col("good"), why).alias("last_error"))
    return {"accepted": x.filter("good").select(*rows), "quarantined": x.filter("NOT good").select(*rows), "queue": queue}


def gate_sink(log: CommitLog) -> Callable[[DataFrame, int], None]:
    return once(log, "gate", _gate)
