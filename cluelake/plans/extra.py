"""Queries on joins, aggregates, windows and streams that the engine offers beside its domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from cluelake.operators import ordered, rules
from cluelake.plans.bindings import sql, view
from cluelake.plans.registry import query
from cluelake.sources import commit, io
from cluelake.streaming import queue, windows

# ---------------------------------------------------------------- joins


@query("""SELECT a.event_id, b.event_id AS last_click FROM (SELECT * FROM {events} WHERE event_type = 'purchase') a
 ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM {events} WHERE event_type = 'click' GROUP BY user_id, ts) b ON b.user_id = a.user_id AND b.ts <= a.ts""")
def as_of_join(s, d):
    """The last click of each purchase's user at or before it."""
    e = io.load_table(s, d, "events")
    clicks = e.filter("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_click"))
    buys = e.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return ordered.as_of(buys, clicks, ["user_id"], "ts", "last_click").select("event_id", "last_click")


# ---------------------------------------------------------------- approximate aggregates


@query("SELECT event_type, true AS close_count, true AS close_median FROM {events} GROUP BY event_type")
def approximate_aggregates(s, d):
    """Sketches of distinct users (HyperLogLog) and of the median, told by how far they are from the exact figures."""
    e = io.load_table(s, d, "events")
    near = e.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("a"), F.count_distinct("user_id").alias("x"), F.approx_percentile("value", 0.5, 1000).alias("p"),
        F.percentile("value", 0.49).alias("lo"), F.percentile("value", 0.51).alias("hi"),
    )
    return near.select("event_type", (F.abs(F.col("a") - F.col("x")) <= 0.1 * F.col("x") + 1).alias("close_count"), F.col("p").between(F.col("lo"), F.col("hi")).alias("close_median"))


# ---------------------------------------------------------------- rules that whole games never break

_EDGE = {
    "episodes": "SELECT episode FROM {clues} UNION SELECT -1 - c_custkey AS episode FROM {customer}",
    "contestants": "SELECT * FROM {contestants} WHERE episode % 101 <> 0 UNION ALL SELECT -1 - c_custkey, 'P0', 1 FROM {customer}",
    "finals": "SELECT episode, CASE WHEN wager % 13 = 0 THEN 'P9' ELSE who END AS who, wager, is_correct FROM {finals}",
}


@query(f"""WITH people AS ({_EDGE['contestants']}), eps AS ({_EDGE['episodes']}), f AS ({_EDGE['finals']}),
 w AS (SELECT 'V1' AS rule, count(*) AS n FROM eps WHERE episode NOT IN (SELECT episode FROM people) UNION ALL SELECT 'V2', count(*) FROM eps WHERE episode NOT IN (SELECT episode FROM {{clues}})
 UNION ALL SELECT 'V17', count(*) FROM f WHERE who = 'P9' AND episode % 101 <> 0 UNION ALL SELECT 'V19', count(*) FROM {{clues}} WHERE raw_row NOT BETWEEN 1 AND 5)
 SELECT * FROM w WHERE n > 0""")
def rule_edges(s, d):
    """V1, V2, V17 and V19, on games without contestants or clues, with unknown finalists and rows off the board."""
    clues = view(s, d, "clues").withColumn("board_row", F.col("raw_row"))
    e = {k: sql(s, d, t) for k, t in _EDGE.items()}
    w = rules.warnings(e["episodes"], clues, view(s, d, "attempts"), e["contestants"], e["finals"], view(s, d, "adjustments"))
    return w.filter(F.col("rule").isin("V1", "V2", "V17", "V19")).groupBy("rule").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- streams


def _events(s, d, files: int = 1):
    """events as a stream, from files of Parquet in time order."""
    e = io.load_table(s, d, "events")
    path = commit.scratch(s, "events")
    e.repartitionByRange(files, "ts").write.parquet(path)
    return s.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _ended(s, stream, name: str, mode: str):
    """What a stream has given when all there is has been taken, with the number of the batch."""
    out = commit.scratch(s, name)
    sink = commit.stream_sink(out, lambda x: {"rows": x})
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", commit.scratch(s, f"{name}-at")).trigger(availableNow=True).start().awaitTermination()
    return commit.read_table(s, out, "rows")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM {events} GROUP BY event_type")
def stream_ingest_available_now(s, d):
    agg = _events(s, d, 2).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    last = _ended(s, agg, "ingested", "complete")
    return last.join(last.agg(F.max("batch").alias("batch")), "batch").select("event_type", "n", "total")


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS w_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM {events} GROUP BY ALL")
def stream_windows(s, d):
    """Windows by event time with a watermark: each is given again as it grows, and the last of them counts; nothing in time order comes late."""
    zoned = _events(s, d, 2).withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks take no other type
    x = windows.tumbling(zoned, "1 day", ["event_type"], late="2 days")
    x = x.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("w_start", "w_end")})
    rows = _ended(s, x, "windows", "update")
    keys = ["w_start", "w_end", "event_type"]
    return rows.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"), F.max_by("total", "batch").alias("total"))


@query("""WITH o AS (SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM {events}), n AS (SELECT id, count(*) AS n FROM o GROUP BY id)
 SELECT id, CASE WHEN n > 3 THEN 'FAILED' ELSE 'PENDING' END AS status, least(n, 3)::INT AS retry_count FROM n""")
def stream_queue(s, d):
    """The keyed state of the queue after a stream of failures: every outcome of a worker is one, so three retries end in FAILED."""
    e = io.load_table(s, d, "events")
    path = commit.scratch(s, "outcomes")
    e.select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.lit("fail").alias("outcome"), F.lit("e").alias("error")).write.parquet(path)
    stream = s.readStream.schema("id long, seq long, outcome string, error string").parquet(path)
    return _ended(s, queue.stream(stream), "queue", "update").select("id", "status", "retry_count")
