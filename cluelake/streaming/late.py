"""What becomes of events that come late: windows that are given out are not changed, and who came too late is kept beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cluelake.sources import commit


def _mark(spark: SparkSession, folder: str, batch: int):
    """The latest event time of the batches before."""
    if batch == 0:
        return None
    return spark.read.parquet(f"{folder}/batch={batch - 1}/marks").first()["latest"]


def policy(folder: str, size: str, delay: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over events (ts, value, the keys): counts and sums by window of `size`, and a side table of the rows that came too late.

    The watermark of a batch is the latest event time of the batches before it,
    less `delay`. A row is late when its window had ended by then; a late row in
    a window that is still open counts. Each batch writes its sums (partials),
    its late rows and the new mark, all at once and only once, so a replayed
    batch changes nothing. A null time belongs to no window: such rows are late.
    """

    def split(spark: SparkSession, events: DataFrame, batch: int) -> dict[str, DataFrame]:
        before = _mark(spark, folder, batch)
        bound = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        us, at = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {size}")), F.unix_micros("ts")
        end = F.timestamp_micros(at - F.pmod(at, us) + us)  # F.window would drop rows without a time
        late = F.lit(False) if before is None else end <= bound
        x = events.withColumns({"watermark": F.lit(None).cast("timestamp") if before is None else bound, "_late": F.col("ts").isNull() | late})
        ok = x.filter(~F.col("_late")).groupBy(F.window("ts", size).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        mark = events.agg(F.greatest(F.max("ts"), F.lit(before).cast("timestamp")).alias("latest"))
        return {"partials": ok.select(F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), *keys, "n", "total"), "late": x.filter("_late").drop("_late"), "marks": mark}

    return lambda df, n: commit.write_batch(split(df.sparkSession, df, n), folder, str(n)) and None


def windows(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """w_start, w_end, the keys, n, total of all windows so far."""
    x = commit.read_table(spark, folder, "partials").groupBy("w_start", "w_end", *keys)
    return x.agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that came too late, with the watermark that they missed and their batch."""
    return commit.read_table(spark, folder, "late")


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], within: str, late: str, how: str = "leftOuter") -> DataFrame:
    """Rows of two streams (each with ts) of equal keys where right came at most `within` before left, or at the same time.

    Both sides' watermarks bound what is kept: a right row goes when no left row
    that isn't late can reach back to it, a left row without a partner is given
    out when none can come any more. Columns of right have the prefix r_.
    """
    a = left.withWatermark("ts", late)
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withWatermark("r_ts", late)
    on: Column = (F.col("r_ts") <= F.col("ts")) & (F.col("r_ts") >= F.col("ts") - F.expr(f"INTERVAL {within}"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"r_{k}"))
    return a.join(b, on, how)
