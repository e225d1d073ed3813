"""Event-time windows over a stream or a table of events (ts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, size: str, keys: list[str], late: str | None = None) -> DataFrame:
    return _counted(events.withWatermark("ts", late) if late else events, F.window("ts", size), keys)


def sliding(events: DataFrame, size: str, step: str, keys: list[str], late: str | None = None) -> DataFrame:
    return _counted(events.withWatermark("ts", late) if late else events, F.window("ts", size, step), keys)


def sessions(events: DataFrame, gap: str, keys: list[str], late: str | None = None) -> DataFrame:
    return _counted(events.withWatermark("ts", late) if late else events, F.session_window("ts", gap), keys)


def _counted(events: DataFrame, window, keys: list[str]) -> DataFrame:
    x = events.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return x.select(F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), *keys, "n", "total")
