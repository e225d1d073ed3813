"""Repeats in a stream: the best of a bucket once no other can come, or the first that came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cluelake.operators.ordered import BUCKET_MS, strip


def best_of_bucket(clues: DataFrame, late: str) -> DataFrame:
    """episode, round, seq, category, start_ms, n_attempts, text, first_seq of a stream of clues, for the append mode.

    As ordered.dedup(), for a stream: of the clues (episode, seq, round, category,
    start_ms, n_attempts, text, started) of one 2 s bucket, round and category
    the one of most attempts counts, then the longest text, then the first.
    started is when an episode began. A bucket is given out, and its state
    dropped, when the watermark, `late` behind the latest bucket's end, passes
    its end; clues of buckets that have been given out are dropped. State holds
    one row for each open bucket, so it doesn't grow with the stream.
    """
    bucket = F.bround(F.col("start_ms") / BUCKET_MS, 0) * BUCKET_MS
    ends = F.timestamp_millis((F.unix_millis("started") + bucket + BUCKET_MS / 2).cast("long"))
    x = clues.withColumns({"ends": ends, "cat": strip("category"), "n_attempts": F.coalesce("n_attempts", F.lit(0))}).withWatermark("ends", late)
    row = F.struct("seq", "category", "start_ms", "n_attempts", "text")
    rank = F.struct("n_attempts", F.length(F.coalesce("text", F.lit(""))), -F.col("seq"))
    best = x.groupBy("ends", "episode", "round", "cat").agg(F.max_by(row, rank).alias("r"), F.min("seq").alias("first_seq"))
    return best.select("episode", "round", "r.*", "first_seq")


def first_of(rows: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Of rows (ts, the keys) the first that came of each key; a repeat is known for `late` after the first."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
