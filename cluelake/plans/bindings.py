"""Game-domain views over the driver's tables, as SQL that Spark and DuckDB both take.

A template names tables and views in braces. sql() runs it in Spark, where
each is a DataFrame; oracle() makes DuckDB's text, where views become common
table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cluelake.sources.io import load_table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

BASE = """SELECT *, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS rn FROM {lineitem}"""
CLUES = """SELECT l_partkey AS episode, CAST(rn AS BIGINT) AS pos, CAST(rn AS BIGINT) AS seq, CAST(rn AS BIGINT) AS selection_order,
  CASE WHEN rn <= 15 THEN 'J!' ELSE 'Double J!' END AS round, CAST(CAST(l_quantity AS INT) % 7 AS INT) AS raw_row,
  CAST(1 + CAST(l_quantity AS INT) % 5 AS INT) AS board_row, CAST(1 + l_suppkey % 7 AS INT) AS board_col,
  concat(l_returnflag, l_linestatus) AS category, l_orderkey % 10 = 0 AS is_dd,
  CASE WHEN l_linenumber <= 3 THEN 'True Daily Double' ELSE CAST(CAST(floor(l_extendedprice / 50) AS INT) AS VARCHAR(20)) END AS wager,
  concat('P', CAST(l_suppkey % 3 AS VARCHAR(20))) AS wagerer,
  CAST(rn * 4000 + l_orderkey % 3000 AS DOUBLE) AS start_ms,
  CAST(rn * 4000 + l_orderkey % 3000 + CASE WHEN l_orderkey % 97 = 0 THEN -500 WHEN l_orderkey % 89 = 0 THEN 61000 ELSE 1000 + l_suppkey % 4000 END AS DOUBLE) AS finish_ms,
  CASE WHEN l_orderkey % 83 = 0 THEN ' ' ELSE concat('clue ', CAST(l_suppkey AS VARCHAR(20))) END AS text,
  CASE WHEN l_orderkey % 79 = 0 THEN '' ELSE 'What is it?' END AS response,
  CAST(l_linenumber % 4 AS BIGINT) AS n_attempts, l_orderkey AS ok, l_suppkey AS sk FROM {base}"""
#: What an attempt and a correction are, by columns of the clue: for the views, and for those that make lists within a clue's row.
ATTEMPT = {"speaker": "concat('P', CAST((sk + k) % 4 AS VARCHAR(20)))", "is_correct": "(ok + 7 * k) % 3 = 0", "buzz_ms": "finish_ms + CAST((ok * 13 + k * 29) % 900 - 100 AS DOUBLE)"}
ADJUSTMENT = {"who": "concat('P', CAST(sk % 4 AS VARCHAR(20)))", "points": "(ok % 5 - 2) * 100", "after": "pos"}
ADJUSTED = "pos % 17 = 0"
_ATTEMPT = f"""episode, pos, k, {ATTEMPT['speaker']} AS speaker, {ATTEMPT['is_correct']} AS is_correct,
  {ATTEMPT['buzz_ms']} AS buzz_ms"""
ATTEMPTS = (
    f"SELECT {_ATTEMPT} FROM (SELECT *, explode(sequence(CAST(1 AS BIGINT), n_attempts)) AS k FROM {{clues}} WHERE n_attempts > 0) x",
    f"SELECT {_ATTEMPT} FROM (SELECT *, unnest(range(1, n_attempts + 1)) AS k FROM {{clues}} WHERE n_attempts > 0) x",
)
CONTESTANTS = """SELECT e.episode, concat('P', CAST(r_regionkey AS VARCHAR(20))) AS who, r_regionkey + 1 AS podium
  FROM (SELECT DISTINCT episode FROM {clues}) e CROSS JOIN (SELECT r_regionkey FROM {region} WHERE r_regionkey < 3) r"""
ADJUSTMENTS = f"SELECT episode, {', '.join(f'{v} AS {n}' for n, v in ADJUSTMENT.items())} FROM {{clues}} WHERE {ADJUSTED}"
FINALS = """SELECT episode, who, (episode * 7 + podium * 1300) % 5000 AS wager, (episode + podium) % 2 = 0 AS is_correct
  FROM {contestants} WHERE (episode + podium) % 4 <> 0"""
SEGMENTS = """SELECT conv_id AS episode, turn AS pos, CASE WHEN turn % 5 = 4 THEN 'SPEAKER_03' ELSE role END AS speaker, text,
  CAST(turn * 10000 + length(text) % 700 AS DOUBLE) AS start_ms, CAST(turn * 10000 + length(text) % 700 + 15 * length(text) AS DOUBLE) AS end_ms FROM {conversations}"""
LINES = """SELECT user_id AS episode, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS pos,
  CASE WHEN event_id % 61 = 0 THEN 'Now the Double J! round' WHEN event_id % 53 = 0 THEN 'and Final Jeopardy' ELSE event_type END AS text FROM {events}"""
# The status graph, for histories.
QUEUE = """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'TRANSCRIPT_READY' WHEN 2 THEN 'CLEANED'
  WHEN 3 THEN 'FAILED' WHEN 4 THEN 'COMPLETED' ELSE 'TRANSCRIBING' END AS status, o_orderdate AS created_at,
  CAST(o_orderkey % 5 AS INT) AS retry_count, CAST(NULL AS VARCHAR(500)) AS last_error FROM {orders}"""
TELEMETRY = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS tokens_in, o_custkey % 900 AS tokens_out, o_orderkey % 300 AS tokens_cached,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 4000 AS DOUBLE) END AS stage_a_ms, CAST(o_custkey % 3000 AS DOUBLE) AS stage_b_ms,
  CAST(NULL AS DOUBLE) AS stage_c_ms, floor(o_totalprice / 10) / 100 AS cost FROM {orders}"""

VIEWS: dict[str, str | tuple[str, str]] = {
    "base": BASE, "clues": CLUES, "attempts": ATTEMPTS, "contestants": CONTESTANTS, "adjustments": ADJUSTMENTS, "finals": FINALS, "segments": SEGMENTS, "lines": LINES, "queue": QUEUE, "telemetry": TELEMETRY,
}
_NAME = re.compile(r"\{(\w+)\}")


def sql(spark: SparkSession, sf_dir: str, template: str, **made: DataFrame) -> DataFrame:
    """made: views that are there already, for this one and those that it names."""
    known = {n: load_table(spark, sf_dir, n) if n in TABLES else view(spark, sf_dir, n, **made) for n in set(_NAME.findall(template))}
    return spark.sql(template, **known)


def view(spark: SparkSession, sf_dir: str, name: str, **made: DataFrame) -> DataFrame:
    if name in made:
        return made[name]
    t = VIEWS[name]
    return sql(spark, sf_dir, t if isinstance(t, str) else t[0], **made)


def _needed(template: str, out: dict[str, str]) -> None:
    for n in dict.fromkeys(_NAME.findall(template)):
        if n in VIEWS and n not in out:
            t = VIEWS[n]
            t = t if isinstance(t, str) else t[1]
            _needed(t, out)
            out[n] = t


def oracle(template: str) -> str:
    views: dict[str, str] = {}
    _needed(template, views)
    ctes = [f"{n} AS MATERIALIZED ({t})" for n, t in views.items()]  # each is made once, however often it is named
    body, recursive = template.strip(), ""
    if m := re.match(r"(?i)WITH\s+(RECURSIVE\s+)?", body):
        recursive = m[1] or ""
        body = body[m.end() :]
        ctes.append(body)
        body = ""
    text = (f"WITH {recursive}" + ", ".join(ctes) + (" " + body if body else "")) if ctes else body
    return _NAME.sub(r"\1", text)
