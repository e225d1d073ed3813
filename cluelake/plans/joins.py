"""Queries on joins by range without a small key, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cluelake.operators import intervals
from cluelake.plans.bindings import sql, view
from cluelake.plans.registry import query

_WORDS = "SELECT CASE event_id % 5 WHEN 0 THEN 'Um,' WHEN 1 THEN 'uh' ELSE event_type END AS word, CAST(event_id AS DOUBLE) / 8 AS start, CAST(event_id AS DOUBLE) / 8 + 1 AS end, CAST(event_id % 7 AS DOUBLE) / 8 AS prob FROM {events}"
_BUZZES = "SELECT DISTINCT CAST(event_id AS DOUBLE) / 4 AS t0, CAST(event_id AS DOUBLE) / 4 + CASE WHEN event_id % 50 = 0 THEN 500 ELSE event_id % 6 END AS t1 FROM {events} WHERE event_type = 'purchase'"


@query(f"""WITH w AS ({_WORDS.replace(' AS end', ' AS "end"')}), b AS ({_BUZZES})
 , g AS (SELECT t0, t1, CAST(avg(prob) AS DECIMAL(20, 12)) * 10000 AS m, count(*) FILTER (WHERE word IN ('Um,', 'uh')) AS disfluencies FROM b LEFT JOIN w ON w.start >= t0 AND w."end" <= t1 GROUP BY t0, t1)
 SELECT t0, t1, coalesce(CAST(CASE WHEN m - floor(m) > 0.5 OR m - floor(m) = 0.5 AND floor(m) % 2 = 1 THEN floor(m) + 1 ELSE floor(m) END AS DOUBLE) / 10000, 0.0) AS confidence, disfluencies FROM g""")
def acoustics_one_recording(s, d):
    """Words within buzzes where one recording holds them all, so that no key deals them out."""
    return intervals.acoustics(sql(s, d, _BUZZES), sql(s, d, _WORDS), [], width=4.0)


_LINE = "SELECT episode, pos, CAST(episode * 3000 + start_ms / 10 AS DOUBLE) AS lo, CAST(episode * 3000 + end_ms / 10 AS DOUBLE) AS hi FROM {segments}"


@query(f"""WITH x AS ({_LINE}) SELECT a.episode, a.pos, count(*) AS n, sum(b.episode) AS others FROM x a JOIN x b ON a.lo < b.hi AND b.lo < a.hi WHERE a.lo < a.hi AND b.lo < b.hi GROUP BY a.episode, a.pos""")
def overlaps_one_timeline(s, d):
    """How many segments, itself included, overlap each segment when all episodes are laid on one line of time."""
    x = sql(s, d, _LINE)
    y = x.select(F.col("episode").alias("episode_b"), F.col("pos").alias("pos_b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    return intervals.overlapping(x, y, [], ("lo", "hi"), ("lo_b", "hi_b"), width=500.0).groupBy("episode", "pos").agg(F.count("*").alias("n"), F.sum("episode_b").alias("others"))


@query("""SELECT a.episode, a.pos AS at, count(*) AS n, min(s.pos) AS first, max(s.pos) AS last, sum(length(s.text))::BIGINT AS chars
 FROM {segments} a JOIN {segments} s ON s.episode = a.episode AND s.pos BETWEEN a.pos - 3 AND a.pos + 8 GROUP BY a.episode, a.pos""")
def context_window_binned(s, d):
    """The segments from 3 before to 8 after each one, whatever an episode's length."""
    seg = view(s, d, "segments")
    x = intervals.segments_around(seg.select("episode", F.col("pos").alias("at")), seg, 3, 8)
    return x.groupBy("episode", "at").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.sum(F.length("text")).cast("long").alias("chars"))
