"""Reports and dashboards that are SQL: the same text runs in Spark and in DuckDB."""

from __future__ import annotations

REPORTS: dict[str, str] = {
    # leaderboards
    "fastest_buzzers": """SELECT a.episode, a.pos, a.k, a.speaker, a.buzz_ms - c.finish_ms AS latency_ms FROM {attempts} a
      JOIN {clues} c ON a.episode = c.episode AND a.pos = c.pos JOIN {contestants} p ON p.episode = a.episode AND p.who = a.speaker
      WHERE a.is_correct AND a.buzz_ms - c.finish_ms > 0 ORDER BY latency_ms, a.episode, a.pos, a.k LIMIT 5""",
    "irrational_wagers": """SELECT f.episode, f.who, f.wager - 2500 AS delta FROM {finals} f JOIN {contestants} p ON p.episode = f.episode AND p.who = f.who
      WHERE abs(f.wager - 2500) > 1000 ORDER BY abs(f.wager - 2500) DESC, f.episode, f.who""",
    "buzzer_latency": """SELECT a.speaker, count(*) AS n, round(avg(a.buzz_ms - c.finish_ms), 4) AS mean_ms, min(a.buzz_ms - c.finish_ms) AS least_ms
      FROM {attempts} a JOIN {clues} c ON a.episode = c.episode AND a.pos = c.pos GROUP BY a.speaker""",
    "triple_stumpers": """SELECT c.episode, count(*) AS n_clues, count_if(coalesce(x.n_right, 0) = 0) AS stumpers, count_if(coalesce(x.n, 0) > 1) AS rebounds
      FROM {clues} c LEFT JOIN (SELECT episode, pos, count(*) AS n, count_if(is_correct) AS n_right FROM {attempts} GROUP BY episode, pos) x
      ON x.episode = c.episode AND x.pos = c.pos GROUP BY c.episode""",
    "buzz_stats": """SELECT episode, speaker, count(*) AS buzzes, count_if(is_correct) AS n_right, round(CAST(100 AS DOUBLE) * count_if(is_correct) / count(*), 4) AS accuracy
      FROM {attempts} GROUP BY episode, speaker""",
    # dashboard
    "status_histogram": "SELECT status, count(*) AS n, round(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 6) AS pct FROM {queue} GROUP BY status",
    "success_rate": "SELECT count(*) AS n, round(CAST(100 AS DOUBLE) * count_if(status = 'COMPLETED') / greatest(count(*), 1), 6) AS completed_pct FROM {queue}",
    "telemetry_totals": """SELECT CAST(sum(tokens_in + tokens_out + tokens_cached) AS BIGINT) AS tokens, CAST(sum(CAST(round(cost * 100) AS BIGINT)) AS BIGINT) AS cost_cents, round(avg(stage_a_ms), 4) AS a_ms,
      round(avg(stage_b_ms), 4) AS b_ms, round(avg(tokens_in), 4) AS mean_in, count(*) AS n FROM {telemetry}""",
    "stage_timing": """SELECT stage, round(avg(ms) / 1000, 3) AS mean_s, round(min(ms) / 1000, 3) AS least_s, round(max(ms) / 1000, 3) AS most_s FROM (
      SELECT 'a' AS stage, stage_a_ms AS ms FROM {telemetry} UNION ALL SELECT 'b', stage_b_ms FROM {telemetry} UNION ALL SELECT 'c', stage_c_ms FROM {telemetry}) x
      WHERE ms IS NOT NULL GROUP BY stage""",
    "recent_rows": "SELECT id, status, created_at FROM {queue} ORDER BY created_at DESC, id DESC LIMIT 10",
    "queue_depth": "SELECT count_if(status IN ('PENDING', 'TRANSCRIBING', 'TRANSCRIPT_READY', 'CLEANED')) AS depth FROM {queue}",
    "usage_rollup": """SELECT coalesce(o_orderpriority, 'TOTAL') AS call, CAST(sum(o_custkey) AS BIGINT) AS tokens_in, CAST(sum(o_orderkey % 900) AS BIGINT) AS tokens_out,
      CAST(sum(o_custkey) * 125 + sum(o_orderkey % 900) * 1000 AS BIGINT) AS cost_e8, max(o_orderkey % 5) AS most_attempts, count(*) AS n FROM {orders} GROUP BY ROLLUP (o_orderpriority)""",
    "scan_summary": """SELECT coalesce(status, 'TOTAL') AS status, count(*) AS n, CAST(sum(id * 1000) AS BIGINT) AS bytes,
      count_if(status NOT IN ('New', 'COMPLETED', 'FAILED')) AS in_progress FROM {queue} GROUP BY ROLLUP (status)""",
    "scan_enriched": """SELECT c.c_custkey, coalesce(max(o.o_orderstatus), 'New') AS status, count(o.o_orderkey) AS n FROM {customer} c
      LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""",
    # transcripts
    "speaker_stats": """SELECT episode, speaker, count(*) AS segments, CAST(sum(length(text) - length(replace(text, ' ', '')) + 1) AS BIGINT) AS n_words,
      sum(greatest(0, end_ms - start_ms)) AS talk_ms FROM {segments} GROUP BY episode, speaker""",
    "likely_host": """SELECT episode, speaker AS host FROM (SELECT episode, speaker, row_number() OVER (PARTITION BY episode ORDER BY n_words DESC, first_pos) AS place FROM (SELECT episode, speaker, min(pos) AS first_pos,
      CAST(sum(length(text) - length(replace(text, ' ', '')) + 1) AS BIGINT) AS n_words FROM {segments} GROUP BY episode, speaker) x) y WHERE place = 1""",
    "speaker_noise": """SELECT x.speaker, n, n >= 5 AS is_real, round(CAST(100 AS DOUBLE) * n / sum(n) OVER (), 6) AS pct, text AS sample FROM (
      SELECT speaker, count(*) AS n, min(episode) AS e FROM {segments} GROUP BY speaker) x JOIN (SELECT speaker, episode, min(pos) AS p FROM {segments} GROUP BY speaker, episode) f ON f.speaker = x.speaker AND f.episode = x.e
      JOIN {segments} s ON s.speaker = x.speaker AND s.episode = x.e AND s.pos = f.p""",
    "segment_density": """SELECT episode, round(avg(w), 6) AS mean_words, count_if(w = 0) AS n_empty, count_if(w BETWEEN 1 AND 2) AS n_short FROM (
      SELECT episode, CASE WHEN trim(text) = '' THEN 0 ELSE length(text) - length(replace(text, ' ', '')) + 1 END AS w FROM {segments}) x GROUP BY episode""",
    "word_count_upper_median": """SELECT lang, max(n_chars) AS most, min(n_chars) AS least, round(avg(n_chars), 4) AS mean, max(CASE WHEN rn = n DIV 2 + 1 THEN n_chars END) AS upper_median
      FROM (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM {documents}) x GROUP BY lang""",
    "timestamp_span": """SELECT episode, min(CASE WHEN start_ms > 0 THEN start_ms END) AS first_ms, max(finish_ms) AS last_ms,
      (max(finish_ms) - min(CASE WHEN start_ms > 0 THEN start_ms END)) / 60000 AS minutes FROM {clues} GROUP BY episode""",
    # rounds
    "round_summary_rollup": """SELECT c.episode, coalesce(c.round, 'TOTAL') AS round, count(*) AS n_clues, count(DISTINCT c.category) AS categories, count_if(c.is_dd) AS dds,
      CAST(sum(c.n_attempts) AS BIGINT) AS buzzes, count_if(coalesce(x.n_right, 0) = 0) AS stumpers, count_if(coalesce(x.n, 0) > 1) AS rebounds, round(avg(length(c.text)), 4) AS mean_chars,
      round(avg(length(c.text) - length(replace(c.text, ' ', '')) + 1), 4) AS mean_words FROM {clues} c LEFT JOIN (SELECT episode, pos, count(*) AS n, count_if(is_correct) AS n_right FROM {attempts} GROUP BY episode, pos) x
      ON x.episode = c.episode AND x.pos = c.pos GROUP BY GROUPING SETS ((c.episode, c.round), (c.episode))""",
    "board_occupancy": """SELECT g.episode, g.round, g.category, g.board_row, coalesce(m, 'empty') AS cell FROM (SELECT episode, round, category, r_regionkey + 1 AS board_row FROM (
      SELECT DISTINCT episode, round, category FROM {clues}) x CROSS JOIN {region}) g LEFT JOIN (SELECT episode, round, category, board_row, max(CASE WHEN is_dd THEN 'x:DD' ELSE 'ok' END) AS m FROM {clues}
      GROUP BY episode, round, category, board_row) c ON c.episode = g.episode AND c.round = g.round AND c.category = g.category AND c.board_row = g.board_row""",
    "category_grid": """SELECT episode, round, category, count(DISTINCT board_row) AS n, max(CASE WHEN board_row = 1 THEN 1 ELSE 0 END) AS r1, max(CASE WHEN board_row = 2 THEN 1 ELSE 0 END) AS r2,
      max(CASE WHEN board_row = 3 THEN 1 ELSE 0 END) AS r3, max(CASE WHEN board_row = 4 THEN 1 ELSE 0 END) AS r4, max(CASE WHEN board_row = 5 THEN 1 ELSE 0 END) AS r5 FROM {clues} GROUP BY episode, round, category""",
    "buzz_overview": """SELECT c.episode, count(*) AS n_clues, CAST(sum(coalesce(x.n, 0)) AS BIGINT) AS n_buzzes, CAST(sum(coalesce(x.n_right, 0)) AS BIGINT) AS n_right, count_if(x.n IS NULL) AS no_attempt
      FROM {clues} c LEFT JOIN (SELECT episode, pos, count(*) AS n, count_if(is_correct) AS n_right FROM {attempts} GROUP BY episode, pos) x ON x.episode = c.episode AND x.pos = c.pos GROUP BY c.episode""",
    "coverage_pct": """SELECT episode, round, count(*) AS cells, round(CAST(100 AS DOUBLE) * count(*) / 30, 4) AS pct, count(*) >= 24 AS ok FROM (
      SELECT DISTINCT episode, round, category, board_row FROM {clues}) x GROUP BY episode, round""",
    # tables
    "fk_filter_keep": "SELECT d.doc_id, d.source FROM {documents} d WHERE EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)",
    "fk_filter_drop": "SELECT d.source, count(*) AS n FROM {documents} d WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id) GROUP BY d.source",
    "unknown_speakers": """SELECT DISTINCT a.episode, a.speaker FROM {attempts} a WHERE NOT EXISTS (SELECT 1 FROM {contestants} c WHERE c.episode = a.episode AND c.who = a.speaker)""",
    "set_operations": """SELECT speaker, n FROM (SELECT speaker, count(*) AS n FROM {attempts} GROUP BY speaker) x WHERE speaker IN (
      SELECT who FROM {contestants} INTERSECT SELECT wagerer FROM {clues}) UNION ALL SELECT who, -1 FROM (SELECT speaker AS who FROM {attempts} EXCEPT SELECT who FROM {contestants}) y""",
    "leaderboard_ranks": """SELECT c_custkey, c_mktsegment, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS place,
      ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS quarter FROM {customer}""",
    "rank_functions": """SELECT c_custkey, round(percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal), 6) AS share, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS place,
      count(*) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS near FROM {customer}""",
    "difference_all": """SELECT priority, count(*) AS n FROM (SELECT o_orderpriority AS priority FROM {orders} EXCEPT ALL SELECT o_orderpriority FROM {orders} WHERE o_orderstatus = 'F') x GROUP BY priority""",
    "full_outer": """SELECT coalesce(l.k, r.k) AS k, l.n AS n_left, r.n AS n_right FROM (SELECT l_suppkey AS k, count(*) AS n FROM {lineitem} GROUP BY l_suppkey) l
      FULL OUTER JOIN (SELECT c_custkey AS k, count(*) AS n FROM {customer} GROUP BY c_custkey) r ON l.k = r.k""",
    "cross_grid": """SELECT r.r_name, t.event_type, t.n FROM {region} r CROSS JOIN (SELECT event_type, count(*) AS n FROM {events} GROUP BY event_type) t""",
    "calendar": """SELECT o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) AS month, datediff(CAST(o_orderdate AS DATE), DATE '1990-01-01') AS days, dayofweek(CAST(o_orderdate AS DATE)) AS weekday,
      CAST(CAST(o_orderdate AS DATE) + INTERVAL '30' DAY AS DATE) AS due FROM {orders}""",
    "shutdown_totals": """SELECT CAST(sum(tokens_in + tokens_out + tokens_cached) AS BIGINT) AS tokens, CAST(sum(CAST(round(cost * 100) AS BIGINT)) AS BIGINT) AS cost_cents, round(avg(stage_a_ms), 4) AS a_ms, count(*) AS n FROM {telemetry}""",
    "cube_status": "SELECT coalesce(o_orderstatus, '*') AS status, coalesce(o_orderpriority, '*') AS priority, count(*) AS n FROM {orders} GROUP BY CUBE (o_orderstatus, o_orderpriority)",
}

#: Where DuckDB writes it in another way.
IN_DUCKDB = {
    "word_count_upper_median": (" DIV ", " // "),
    "calendar": ("datediff(CAST(o_orderdate AS DATE), DATE '1990-01-01') AS days, dayofweek(CAST(o_orderdate AS DATE)) AS weekday", "date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS days, dayofweek(CAST(o_orderdate AS DATE)) + 1 AS weekday"),
}
