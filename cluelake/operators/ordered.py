"""Deduplication and order of clues: bucketed dedup, row repair, chronological numbers, overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 2000


def strip(c):
    """Lower-cased, without white space at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"^\s+", ""), r"\s+$", "")


def dedup(clues: DataFrame) -> DataFrame:
    """Of clues (episode, seq, round, category, start_ms, n_attempts, text) in one 2 s bucket, round and category keeps the one of most attempts, then the longest text, then the first. first_seq orders the result."""
    key = ["episode", "bucket", "round", "cat"]
    x = clues.withColumns({"bucket": F.bround(F.col("start_ms") / BUCKET_MS, 0) * BUCKET_MS, "cat": strip("category")})
    best = Window.partitionBy(*key).orderBy(F.desc("n_attempts"), F.desc(F.length("text")), "seq")
    x = x.withColumns({"rn": F.row_number().over(best), "first_seq": F.min("seq").over(Window.partitionBy(*key))})
    return x.filter("rn = 1").drop("rn", "bucket", "cat")


def repair_rows(clues: DataFrame) -> DataFrame:
    """clues (episode, seq, round, category, board_row) with fixed_row: the first holder of a valid row keeps it, others get the lowest free rows in order, or stay as they are."""
    g = ["episode", "round", "category"]
    first = Window.partitionBy(*g, "board_row").orderBy("seq")
    x = clues.withColumn("keeps", (F.row_number().over(first) == 1) & F.col("board_row").between(1, 5))
    all_ = Window.partitionBy(*g)
    x = x.withColumn("free", F.array_except(F.sequence(F.lit(1), F.lit(5)), F.collect_set(F.when(F.col("keeps"), F.col("board_row"))).over(all_)))
    x = x.withColumn("i", F.row_number().over(Window.partitionBy(*g, "keeps").orderBy("seq")))
    return x.withColumn("fixed_row", F.when(F.col("keeps"), F.col("board_row")).otherwise(F.coalesce(F.expr("try_element_at(free, i)"), F.col("board_row")))).drop("keeps", "free", "i")


def chronological(clues: DataFrame) -> DataFrame:
    """selection_order: 1.. by start, ties in the order they came."""
    return clues.withColumn("selection_order", F.row_number().over(Window.partitionBy("episode").orderBy("start_ms", "seq")))


def repeated_rows(clues: DataFrame) -> DataFrame:
    """Every clue after the first at its (round, category, row)."""
    w = Window.partitionBy("episode", "round", "category", "board_row").orderBy("seq")
    return clues.withColumn("nth", F.row_number().over(w)).filter("nth > 1")


def overlaps(clues: DataFrame) -> DataFrame:
    """Clues that start before the one before them in their round has finished: at most 5 of the first round, and max(1, 5 - those) of the second."""
    w = Window.partitionBy("episode", "round").orderBy("start_ms", "seq")
    x = clues.filter(F.col("round").isin("J!", "Double J!")).withColumn("before", F.lag("finish_ms").over(w)).filter("start_ms < before")
    x = x.withColumn("nth", F.row_number().over(w))
    n = F.sum(F.when(F.col("round") == "J!", 1).otherwise(0)).over(Window.partitionBy("episode"))
    x = x.withColumn("n_first", F.least(F.lit(5), n))
    return x.filter(F.when(F.col("round") == "J!", F.col("nth") <= 5).otherwise(F.col("nth") <= F.greatest(F.lit(1), 5 - F.col("n_first")))).drop("n_first")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """left with the value (not null) of the last row of right at or before its time, within keys.

    One sort of both sides by key and time instead of a join by range; rows of
    right come first where times are equal.
    """
    a = left.withColumns({"_side": F.lit(1), "_v": F.lit(None).cast(right.schema[value].dataType)})
    b = right.select(*keys, time, F.lit(0).alias("_side"), F.col(value).alias("_v"))
    w = Window.partitionBy(*keys).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn(value, F.last("_v", ignorenulls=True).over(w))
    return both.filter("_side = 1").select(*left.columns, value)
