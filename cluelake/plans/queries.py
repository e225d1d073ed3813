"""Queries over the driver's tables, each with the SQL that DuckDB runs to check it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cluelake.functions import board, recover, text, timing, vector
from cluelake.operators import names, ordered, replay, rules, tables, transcript
from cluelake.plans.bindings import oracle, sql, view
from cluelake.plans.registry import ORACLES, QUERIES, query
from cluelake.plans.reports import IN_DUCKDB, REPORTS
from cluelake.sources.io import load_table
from cluelake.streaming import queue, windows

for _name, _text in REPORTS.items():
    QUERIES[_name] = lambda s, d, t=_text: sql(s, d, t)
    ORACLES[_name] = oracle(_text.replace(*IN_DUCKDB.get(_name, ("", ""))))

# ---------------------------------------------------------------- replay

_EVENTS = """known AS (SELECT a.*, c.round, c.board_row * CASE c.round WHEN 'J!' THEN 200 WHEN 'Double J!' THEN 400 ELSE 0 END AS face, c.is_dd AND c.wager IS NOT NULL AND c.wagerer <> '' AS dd, c.wager, c.wagerer
  FROM {attempts} a JOIN {clues} c ON a.episode = c.episode AND a.pos = c.pos),
scored AS (SELECT * FROM (SELECT *, coalesce(max(is_correct::INT) OVER (PARTITION BY episode, pos ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM known WHERE NOT dd AND speaker IN ('P0', 'P1', 'P2')) q WHERE done = 0),
ev AS (SELECT episode, speaker AS who, pos, k AS sub, 'add' AS kind, CASE WHEN is_correct THEN face ELSE -face END AS v, 0 AS m, CASE WHEN is_correct THEN face ELSE -face END AS coryat FROM scored
  UNION ALL SELECT episode, wagerer, pos, 0, CASE WHEN wager <> 'True Daily Double' THEN 'add' WHEN is_correct THEN 'tdd+' ELSE 'tdd-' END,
    coalesce(CASE WHEN is_correct THEN 1 ELSE -1 END * try_cast(wager AS BIGINT), 0), CASE round WHEN 'Double J!' THEN 2000 ELSE 1000 END, CASE WHEN is_correct THEN face ELSE -face END FROM known WHERE dd AND k = 1
  UNION ALL SELECT a.episode, a.who, c.pos, 100, 'add', a.points, 0, 0 FROM {adjustments} a JOIN {clues} c ON c.episode = a.episode AND c.pos = a.after
  UNION ALL SELECT f.episode, f.who, 1000000, 0, 'add', CASE WHEN f.is_correct THEN f.wager ELSE -f.wager END, 0, 0 FROM {finals} f),
num AS (SELECT *, row_number() OVER (PARTITION BY episode, who ORDER BY pos, sub) AS n FROM ev),
fold AS (SELECT episode, who, n, pos, CASE kind WHEN 'tdd+' THEN greatest(0, m) WHEN 'tdd-' THEN -greatest(0, m) ELSE v END::BIGINT AS score FROM num WHERE n = 1
  UNION ALL SELECT x.episode, x.who, x.n, x.pos, (f.score + CASE x.kind WHEN 'tdd+' THEN greatest(f.score, x.m) WHEN 'tdd-' THEN -greatest(f.score, x.m) ELSE x.v END)::BIGINT
  FROM fold f JOIN num x ON x.episode = f.episode AND x.who = f.who AND x.n = f.n + 1)"""


def _game(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: view(s, d, n) for n in ("clues", "attempts", "contestants", "adjustments", "finals")}


def _events(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    g = _game(s, d)
    return replay.events(**g), g["contestants"]


@query(f"WITH RECURSIVE {_EVENTS} SELECT c.episode, c.who, coalesce(f.score, 0)::BIGINT AS final_score, coalesce(k.coryat, 0)::BIGINT AS coryat FROM {{contestants}} c LEFT JOIN (SELECT episode, who, max_by(score, n) AS score FROM fold GROUP BY episode, who) f ON f.episode = c.episode AND f.who = c.who LEFT JOIN (SELECT episode, who, sum(coryat) AS coryat FROM ev GROUP BY episode, who) k ON k.episode = c.episode AND k.who = c.who")
def scoreboard(s, d):
    ev, people = _events(s, d)
    return replay.scores(ev, people)


@query(f"WITH RECURSIVE {_EVENTS} SELECT episode, who, n::BIGINT AS n, pos::BIGINT AS pos, score FROM fold")
def running_score(s, d):
    return replay.running(_events(s, d)[0])


@query(f"WITH RECURSIVE {_EVENTS} SELECT who, score AS best, episode FROM (SELECT c.episode, c.who, coalesce(k.coryat, 0)::BIGINT AS score FROM {{contestants}} c LEFT JOIN (SELECT episode, who, sum(coryat) AS coryat FROM ev GROUP BY episode, who) k ON k.episode = c.episode AND k.who = c.who) x ORDER BY score DESC, episode, who LIMIT 10")
def top_coryat(s, d):
    ev, people = _events(s, d)
    return replay.scores(ev, people).orderBy(F.desc("coryat"), "episode", "who").limit(10).select("who", F.col("coryat").alias("best"), "episode")


@query(f"WITH RECURSIVE {_EVENTS} SELECT x.episode, x.who, x.pos, greatest(coalesce(f.score, 0), x.m)::BIGINT AS stake FROM num x LEFT JOIN fold f ON f.episode = x.episode AND f.who = x.who AND f.n = x.n - 1 WHERE x.kind <> 'add'")
def true_dd_resolved(s, d):
    ev, _ = _events(s, d)
    run = replay.running(ev)
    before = F.coalesce(F.lag("score").over(Window.partitionBy("episode", "who").orderBy("n")), F.lit(0))
    x = run.withColumn("stake", F.abs(F.col("score") - before))
    return x.join(ev.filter("kind <> 'add'").select("episode", "who", "pos"), ["episode", "who", "pos"]).groupBy("episode", "who", "pos").agg(F.min_by("stake", "n").alias("stake"))


@query(f"WITH RECURSIVE {_EVENTS} SELECT episode, pos, k, speaker FROM scored")
def first_correct_cutoff(s, d):
    g = _game(s, d)
    return replay.scored_attempts(g["clues"], g["attempts"], g["contestants"]).select("episode", "pos", "k", "speaker")


_HOLDER = """got AS (SELECT episode, pos, speaker AS g FROM scored WHERE is_correct UNION ALL SELECT episode, pos, wagerer FROM known WHERE dd AND k = 1 AND is_correct),
hold AS (SELECT c.episode, c.pos, last_value(g.g IGNORE NULLS) OVER (PARTITION BY c.episode ORDER BY c.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  last_value(g.g IGNORE NULLS) OVER (PARTITION BY c.episode ORDER BY c.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS holder FROM {clues} c LEFT JOIN got g ON g.episode = c.episode AND g.pos = c.pos)"""


@query(f"WITH RECURSIVE {_EVENTS}, {_HOLDER} SELECT episode, pos, before, holder FROM hold")
def board_control(s, d):
    g = _game(s, d)
    return replay.control(g["clues"], g["attempts"], g["contestants"])


@query(f"WITH RECURSIVE {_EVENTS}, {_HOLDER} SELECT episode, holder AS who, count(*) AS changes FROM (SELECT *, lag(holder) OVER (PARTITION BY episode ORDER BY pos) AS b FROM hold) x WHERE holder IS NOT NULL AND holder IS DISTINCT FROM b GROUP BY episode, holder")
def control_changes(s, d):
    return replay.control_changes(board_control(s, d))


@query(f"""WITH RECURSIVE {_EVENTS} SELECT c.episode, c.who, coalesce(a.buzzes, 0)::BIGINT AS buzzes, coalesce(a.n_right, 0)::BIGINT AS n_right, round(100.0::DOUBLE * a.n_right / a.buzzes, 4) AS accuracy,
 row_number() OVER (PARTITION BY c.episode ORDER BY coalesce(z.score, 0) DESC, c.who) AS place, coalesce(b.score, 0)::BIGINT AS before_final, f.wager::BIGINT AS final_wager, coalesce(z.score, 0)::BIGINT AS final_score FROM {{contestants}} c
 LEFT JOIN (SELECT episode, speaker, count(*) AS buzzes, count_if(is_correct) AS n_right FROM {{attempts}} GROUP BY episode, speaker) a ON a.episode = c.episode AND a.speaker = c.who
 LEFT JOIN (SELECT episode, who, max_by(score, n) AS score FROM fold WHERE pos < 1000000 GROUP BY episode, who) b ON b.episode = c.episode AND b.who = c.who
 LEFT JOIN (SELECT episode, who, max_by(score, n) AS score FROM fold GROUP BY episode, who) z ON z.episode = c.episode AND z.who = c.who
 LEFT JOIN {{finals}} f ON f.episode = c.episode AND f.who = c.who""")
def contestant_matrix(s, d):
    g = _game(s, d)
    ev = replay.events(**g)
    key = ["episode", "who"]
    by_score = Window.partitionBy("episode").orderBy(F.desc("final_score"), "who")
    tries = g["attempts"].groupBy("episode", F.col("speaker").alias("who")).agg(F.count("*").alias("buzzes"), F.count_if("is_correct").alias("n_right"))
    pre = replay.scores(ev.filter(F.col("pos") < replay.LAST), g["contestants"]).select(*key, F.col("final_score").alias("before_final"))
    x = g["contestants"].select(*key).join(tries, key, "left").join(pre, key).join(replay.scores(ev, g["contestants"]).select(*key, "final_score"), key)
    x = x.join(g["finals"].select(*key, F.col("wager").cast("long").alias("final_wager")), key, "left")
    x = x.withColumns({"accuracy": F.round(100.0 * F.col("n_right") / F.col("buzzes"), 4), "place": F.row_number().over(by_score).cast("long")})
    return x.select(*key, F.coalesce("buzzes", F.lit(0)).alias("buzzes"), F.coalesce("n_right", F.lit(0)).alias("n_right"), "accuracy", "place", "before_final", "final_wager", "final_score")


# ---------------------------------------------------------------- order, rows, rules


@query("WITH b AS (SELECT *, round_even(start_ms / 8000 / 2, 0) AS bucket FROM {clues}) SELECT episode, seq FROM (SELECT *, row_number() OVER (PARTITION BY episode, bucket, round, lower(trim(category)) ORDER BY n_attempts DESC, length(text) DESC, seq) AS rn FROM b) x WHERE rn = 1")
def dedup_bucket(s, d):
    c = view(s, d, "clues").withColumn("start_ms", F.col("start_ms") / 8)  # closer together, so that some meet in a bucket
    return ordered.dedup(c).select("episode", "seq")


@query("SELECT episode, seq, row_number() OVER (PARTITION BY episode ORDER BY start_ms, seq) AS selection_order FROM (SELECT episode, seq, start_ms % 7000 AS start_ms FROM {clues}) x")
def reindex_order(s, d):
    return ordered.chronological(view(s, d, "clues").withColumn("start_ms", F.col("start_ms") % 7000)).select("episode", "seq", F.col("selection_order").cast("long").alias("selection_order"))


@query("SELECT episode, seq FROM (SELECT *, row_number() OVER (PARTITION BY episode, round, category, board_row ORDER BY seq) AS nth FROM {clues}) x WHERE nth > 1")
def dup_rows(s, d):
    return ordered.repeated_rows(view(s, d, "clues")).select("episode", "seq")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY episode, round, category, raw_row ORDER BY seq) = 1 AND raw_row BETWEEN 1 AND 5 AS keeps FROM {clues}),
 h AS (SELECT episode, round, category, coalesce(list(raw_row) FILTER (WHERE keeps), []) AS held FROM k GROUP BY episode, round, category),
 f AS (SELECT episode, round, category, list_filter([1, 2, 3, 4, 5], lambda r: NOT list_contains(held, r)) AS free FROM h),
 i AS (SELECT *, row_number() OVER (PARTITION BY episode, round, category, keeps ORDER BY seq) AS i FROM k)
 SELECT i.episode, i.seq, CASE WHEN keeps THEN raw_row ELSE coalesce(free[i.i], raw_row) END AS fixed_row FROM i JOIN f ON f.episode = i.episode AND f.round = i.round AND f.category = i.category""")
def row_fix(s, d):
    c = view(s, d, "clues").withColumn("board_row", F.col("raw_row"))
    return ordered.repair_rows(c).select("episode", "seq", "fixed_row")


_OVERLAPS = """ov AS (SELECT *, row_number() OVER (PARTITION BY episode, round ORDER BY start_ms, seq) AS nth FROM (SELECT *, lag(finish_ms) OVER (PARTITION BY episode, round ORDER BY start_ms, seq) AS b FROM {clues}) x WHERE start_ms < b),
 cap AS (SELECT *, least(5, count_if(round = 'J!') OVER (PARTITION BY episode)) AS nj FROM ov)"""


@query(f"WITH {_OVERLAPS} SELECT episode, seq, round FROM cap WHERE CASE WHEN round = 'J!' THEN nth <= 5 ELSE nth <= greatest(1, 5 - nj) END")
def overlaps_capped(s, d):
    return ordered.overlaps(view(s, d, "clues")).select("episode", "seq", "round")


@query("WITH g AS (SELECT episode, round, category, r FROM (SELECT DISTINCT episode, round, category FROM {clues}) x, unnest([1, 2, 3, 4, 5]) t(r)) SELECT g.episode, g.round, g.category, count(*) AS n_missing, min(r) AS first_missing FROM g LEFT JOIN (SELECT DISTINCT episode, round, category, board_row FROM {clues}) c ON c.episode = g.episode AND c.round = g.round AND c.category = g.category AND c.board_row = g.r WHERE c.board_row IS NULL GROUP BY g.episode, g.round, g.category")
def category_gaps(s, d):
    c = view(s, d, "clues")
    x = board.missing_rows(c, c.select("episode", "round", "category").distinct())
    return x.select("episode", "round", "category", F.size("missing").cast("long").alias("n_missing"), F.array_min("missing").alias("first_missing"))


_RULES = f"""{_OVERLAPS}, per AS (SELECT episode, count_if(round = 'J!') AS n0, count_if(round <> 'J!') AS n1, count_if(round = 'J!' AND is_dd) AS d0, count_if(round <> 'J!' AND is_dd) AS d1,
 count_if(trim(text) = '') AS v22, count_if(response = '') AS v23, count_if(finish_ms < start_ms) AS v24, count_if(selection_order > 3 AND start_ms = 0) AS v25, count_if(finish_ms - start_ms > 60000) AS v26 FROM {{clues}} GROUP BY episode),
 tries AS (SELECT episode, pos, count(*) AS t FROM {{attempts}} GROUP BY episode, pos), cats AS (SELECT episode, round, count(DISTINCT category) AS k, count(*) AS n FROM {{clues}} GROUP BY episode, round),
 w AS (SELECT episode, 'V3' AS rule FROM per WHERE n0 > 30 UNION ALL SELECT episode, 'V4' FROM per WHERE n1 > 30 UNION ALL SELECT episode, 'V5' FROM per WHERE n0 = 0 UNION ALL SELECT episode, 'V7' FROM per WHERE n1 = 0
 UNION ALL SELECT episode, 'V6' FROM per WHERE n0 BETWEEN 1 AND 14 UNION ALL SELECT episode, 'V8' FROM per WHERE n1 BETWEEN 1 AND 14
 UNION ALL SELECT episode, 'V9' FROM cap WHERE CASE WHEN round = 'J!' THEN nth <= 5 ELSE nth <= greatest(1, 5 - nj) END
 UNION ALL SELECT episode, 'V10' FROM per WHERE d0 + d1 > 3 UNION ALL SELECT episode, 'V11' FROM per WHERE d0 > 1 UNION ALL SELECT episode, 'V12' FROM per WHERE d1 > 2
 UNION ALL SELECT c.episode, 'V13' FROM {{clues}} c JOIN tries t ON t.episode = c.episode AND t.pos = c.pos WHERE c.is_dd AND t.t > 1
 UNION ALL SELECT episode, 'V14' FROM {{clues}} WHERE is_dd AND try_cast(wager AS BIGINT) <= 0 UNION ALL SELECT episode, 'V15' FROM {{clues}} WHERE is_dd AND try_cast(wager AS BIGINT) > 50000
 UNION ALL SELECT DISTINCT episode, 'V16' FROM {{attempts}} WHERE speaker NOT IN ('P0', 'P1', 'P2') UNION ALL SELECT episode, 'V18' FROM {{adjustments}} WHERE who NOT IN ('P0', 'P1', 'P2')
 UNION ALL SELECT episode, 'V20' FROM {{clues}} WHERE board_col NOT BETWEEN 1 AND 6
 UNION ALL SELECT episode, 'V21' FROM (SELECT episode, row_number() OVER (PARTITION BY episode, round, category, board_row ORDER BY seq) AS nth FROM {{clues}}) x WHERE nth > 1
 UNION ALL SELECT episode, 'V22' FROM per WHERE v22 > 0 UNION ALL SELECT episode, 'V23' FROM per WHERE v23 > 0 UNION ALL SELECT episode, 'V24' FROM per WHERE v24 > 0 UNION ALL SELECT episode, 'V25' FROM per WHERE v25 > 0 UNION ALL SELECT episode, 'V26' FROM per WHERE v26 > 0
 UNION ALL SELECT DISTINCT a.episode, 'V27' FROM {{attempts}} a JOIN {{clues}} c ON c.episode = a.episode AND c.pos = a.pos WHERE a.buzz_ms < c.start_ms
 UNION ALL SELECT episode, 'V28' FROM cats WHERE k > 6 UNION ALL SELECT episode, 'V29' FROM cats WHERE k < 5 AND n > 15
 UNION ALL SELECT episode, 'V30' FROM {{finals}} GROUP BY episode HAVING count(*) = 1)"""


def _warned(s, d):
    g = _game(s, d)
    episodes = g["clues"].select("episode").distinct()
    return episodes, g["clues"], rules.warnings(episodes, g["clues"], g["attempts"], g["contestants"], g["finals"], g["adjustments"])


@query(f"WITH {_RULES} SELECT rule, count(*) AS n, count(DISTINCT episode) AS episodes FROM w GROUP BY rule")
def rule_counts(s, d):
    return _warned(s, d)[2].groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("episode").alias("episodes"))


@query(f"""WITH {_RULES} SELECT p.episode, n0 + n1 AS n_clues, coalesce(x.weight, 0) AS weight, CASE WHEN n0 + n1 < 45 OR x.n > 3 THEN 'FAIL' WHEN x.n > 0 THEN 'DEGRADED' ELSE 'PASS' END AS label, n0 + n1 >= 45 AND coalesce(x.weight, 0) <= 3 AS accepted
 FROM per p LEFT JOIN (SELECT episode, count(*) AS n, sum(CASE rule WHEN 'V21' THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM w GROUP BY episode) x ON x.episode = p.episode""")
def quality_label(s, d):
    return rules.quality(*_warned(s, d))


# ---------------------------------------------------------------- transcripts


@query("SELECT episode, string_agg('L' || pos || ' ' || regexp_replace(speaker, '^SPEAKER_', 'S') || ': ' || regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), chr(10) ORDER BY pos) AS transcript FROM {segments} GROUP BY episode")
def compressed_transcript(s, d):
    return transcript.compressed(view(s, d, "segments"))


@query("SELECT episode, pos, start_ms - b AS gap_ms FROM (SELECT *, lag(end_ms) OVER (PARTITION BY episode ORDER BY pos) AS b FROM {segments}) x WHERE start_ms - b > 3000")
def silence_gaps(s, d):
    return transcript.gaps(view(s, d, "segments")).select("episode", "pos", "gap_ms")


@query("SELECT episode, pos FROM (SELECT *, lag(start_ms % 7000) OVER (PARTITION BY episode ORDER BY pos) AS b FROM {segments}) x WHERE start_ms % 7000 < b - 500")
def monotonic_violations(s, d):
    return transcript.backwards(view(s, d, "segments").withColumn("start_ms", F.col("start_ms") % 7000)).select("episode", "pos")


@query("SELECT a.episode, a.pos AS at, count(*) AS n, sum(length(s.text))::BIGINT AS chars FROM {segments} a JOIN {segments} s ON s.episode = a.episode AND s.pos BETWEEN a.pos - 3 AND a.pos + 8 GROUP BY a.episode, a.pos")
def context_window(s, d):
    seg = view(s, d, "segments")
    return transcript.in_range(seg.select("episode", F.col("pos").alias("at")), seg, 3, 8).groupBy("episode", "at").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


_REGIONS = """dj AS (SELECT episode, min(pos) AS dj FROM {lines} WHERE pos > 10 AND contains(lower(text), 'double j!') GROUP BY episode),
 fj AS (SELECT l.episode, min(pos) AS fj FROM {lines} l JOIN dj ON dj.episode = l.episode WHERE pos > dj + 10 AND contains(lower(text), 'final jeopardy') GROUP BY l.episode),
 x AS (SELECT l.episode, l.pos, dj, fj FROM {lines} l LEFT JOIN dj ON dj.episode = l.episode LEFT JOIN fj ON fj.episode = l.episode)"""


@query(f"WITH {_REGIONS} SELECT episode, region, count(*) AS n, min(pos) AS first_pos FROM (SELECT *, 'J' AS region FROM x WHERE dj IS NULL OR pos < dj + 20 UNION ALL SELECT *, 'DJ' FROM x WHERE pos >= dj - 20 AND (fj IS NULL OR pos < fj + 20) UNION ALL SELECT *, 'FJ' FROM x WHERE pos >= fj) y GROUP BY episode, region")
def round_split(s, d):
    return transcript.round_regions(view(s, d, "lines")).groupBy("episode", "region").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


@query("""WITH RECURSIVE m AS (SELECT episode, pos FROM {lines} WHERE contains(lower(text), 'double j!') OR contains(lower(text), 'final jeopardy')), top AS (SELECT episode, max(pos) AS top FROM {lines} GROUP BY episode),
 cut AS (SELECT episode, -1::BIGINT AS cp FROM top UNION ALL SELECT c.episode, (SELECT min(m.pos) FROM m WHERE m.episode = c.episode AND m.pos - c.cp > 10) FROM cut c WHERE (SELECT min(m.pos) FROM m WHERE m.episode = c.episode AND m.pos - c.cp > 10) IS NOT NULL),
 e AS (SELECT episode, cp AS a, coalesce(lead(cp) OVER (PARTITION BY episode ORDER BY cp), (SELECT top FROM top WHERE top.episode = cut.episode)) AS b FROM cut),
 ab AS (SELECT episode, a + 1 AS a, b FROM e WHERE a + 1 <= b),
 s AS (SELECT episode, a, b, unnest(CASE WHEN b - a + 1 > 60 THEN range(a, b + 1, 50) ELSE [a] END) AS first FROM ab)
 SELECT episode, first, CASE WHEN b - a + 1 > 60 THEN least(first + 59, b) ELSE b END AS last, row_number() OVER (PARTITION BY episode ORDER BY first) AS chunk FROM s""")
def size_chunks(s, d):
    return transcript.chunks(view(s, d, "lines"), most=60, overlap=10)


@query("SELECT episode, pos, (row_number() OVER (PARTITION BY episode ORDER BY pos) - 1) // 12 AS batch, (row_number() OVER (PARTITION BY episode ORDER BY pos) - 1) % 12 AS slot FROM {lines}")
def batches_of_12(s, d):
    return transcript.batches(view(s, d, "lines"), "episode", "pos").select("episode", "pos", F.col("batch").cast("long").alias("batch"), F.col("slot").cast("long").alias("slot"))


@query("SELECT episode, pos FROM (SELECT *, max(pos) OVER (PARTITION BY episode) AS top FROM {lines}) x WHERE top - pos < 40")
def tail_window(s, d):
    return transcript.tail(view(s, d, "lines")).select("episode", "pos")


@query("SELECT a.episode, a.pos AS line, s.start_ms AS seg_start, s.end_ms AS seg_end FROM (SELECT episode, pos, greatest(0, least(pos * 2 - 1, 7)) AS want FROM {segments}) a LEFT JOIN {segments} s ON s.episode = a.episode AND s.pos = a.want")
def line_lookup(s, d):
    seg = view(s, d, "segments")
    want = seg.select("episode", F.col("pos").alias("line"), text.clamped((F.col("pos") * 2 - 1).cast("int"), F.lit(8)).cast("long").alias("want"))
    return transcript.at_line(want, seg, "want", "seg").select("episode", "line", "seg_start", "seg_end")


_STOP = ", ".join(f"'{w}'" for w in text.NO_NAMES)


@query(f"""WITH turns AS (SELECT episode, speaker, count(*) AS k, min(pos) AS p FROM {{segments}} GROUP BY episode, speaker), host AS (SELECT episode, speaker FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY k DESC, p) AS r FROM turns) x WHERE r = 1),
 w AS (SELECT s.episode, s.pos, list_filter(regexp_extract_all(s.text, '[\\p{{{{L}}}}\\p{{{{N}}}}_]+'), lambda x: regexp_matches(x, '^[A-Z][a-z]{{2,}}$')) AS w FROM {{segments}} s JOIN host h ON h.episode = s.episode AND h.speaker = s.speaker),
 said AS (SELECT episode, pos, unnest(w) AS name, generate_subscripts(w, 1) AS i FROM w),
 n AS (SELECT episode, name, count(*) AS n, row_number() OVER (PARTITION BY episode ORDER BY count(*) DESC, min(pos), min_by(i, pos * 1000000.0 + i)) AS r FROM said WHERE name NOT IN ({_STOP}) GROUP BY episode, name)
 SELECT episode, name, n, r AS rank FROM n WHERE r <= 3""")
def name_mentions(s, d):
    return transcript.name_mentions(view(s, d, "segments")).withColumn("rank", F.col("rank").cast("long"))


# ---------------------------------------------------------------- texts and values

_SELECTION = "concat(CASE doc_id % 4 WHEN 0 THEN 'Trees for $' WHEN 1 THEN 'Let''s go with that for ' WHEN 2 THEN 'my score is $' ELSE 'I take $' END, CAST((doc_id % 24) * 100 AS VARCHAR(20)), '. ', text)"
_WORDS_IN = text.SCORE_CONTEXT.replace("'", "''")
_VALUES = ", ".join(map(str, text.CLUE_VALUES))


@query(f"""WITH t AS (SELECT doc_id, {_SELECTION} AS x FROM {{documents}}), v AS (SELECT doc_id, x, try_cast(replace(regexp_extract(x, '(?i)\\bfor\\s+\\$([\\d,]+)', 1), ',', '') AS INT) AS a, try_cast(replace(regexp_extract(x, '\\$([\\d,]+)', 1), ',', '') AS INT) AS b, try_cast(regexp_extract(x, '\\bfor\\s+(\\d{{3,4}})\\b', 1) AS INT) AS c FROM t)
 SELECT doc_id, coalesce(CASE WHEN a IN ({_VALUES}) THEN a END, CASE WHEN b IN ({_VALUES}) AND NOT regexp_matches(x, '{_WORDS_IN}') THEN b END, CASE WHEN c IN ({_VALUES}) THEN c END) AS value FROM v""")
def dollar_parse(s, d):
    x = sql(s, d, f"SELECT doc_id, {_SELECTION} AS x FROM {{documents}}")
    return x.select("doc_id", text.dollar_value(F.col("x")).alias("value"))


@query(None)
def row_infer(s, d):
    x = load_table(s, d, "documents").select("doc_id", (F.col("doc_id") % 26 * 100).cast("int").alias("v"), F.when(F.col("doc_id") % 3 == 0, "J!").when(F.col("doc_id") % 3 == 1, "Double J!").otherwise("Final J!").alias("round"), (F.col("doc_id") % 9).cast("int").alias("fall"))
    return x.select("doc_id", board.row_of(F.when(F.col("doc_id") % 5 != 0, F.col("v")), F.col("round"), F.col("fall")).cast("int").alias("board_row"))


_GRID = "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN [200, 400, 600, 800, 1000] ELSE [400, 800, 1200, 1600, 2000] END AS g, CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 26 * 100)::INT END AS v, least(5, greatest(1, (doc_id % 9)::INT)) AS f FROM {documents}"
ORACLES["row_infer"] = oracle(f"""WITH x AS ({_GRID}), y AS (SELECT doc_id, v, f, list_transform(g, lambda q: abs(q - v)) AS dist FROM x)
 SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 1 WHEN v IS NULL THEN f WHEN list_min(dist) <= 100 THEN list_position(dist, list_min(dist)) ELSE f END::INT AS board_row FROM y""")


@query("SELECT doc_id, CASE WHEN regexp_matches(h, '\\$100\\b') AND NOT regexp_matches(h, '\\$200\\b') THEN 'classic' ELSE 'standard' END AS format FROM (SELECT doc_id, x[1:(length(x) * 2 // 5)] AS h FROM (SELECT doc_id, concat(CASE doc_id % 3 WHEN 0 THEN 'for $100 ' WHEN 1 THEN '$200 and $100 ' ELSE '' END, text) AS x FROM {documents}) y) z")
def board_format(s, d):
    x = sql(s, d, "SELECT doc_id, concat(CASE doc_id % 3 WHEN 0 THEN 'for $100 ' WHEN 1 THEN '$200 and $100 ' ELSE '' END, text) AS x FROM {documents}")
    return x.select("doc_id", board.board_format(F.col("x")).alias("format"))


_PRE = text.PREAMBLE.replace("'", "''")


@query(f"""WITH t AS (SELECT doc_id, {_SELECTION} AS x, CASE WHEN doc_id % 8 = 0 THEN 'trees' ELSE 'zzz' END AS cat FROM {{documents}}),
 r AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(x, '{_PRE}', ''), '^\\s+', ''), '\\s+$', '') AS rest FROM t)
 SELECT doc_id, CASE WHEN (starts_with(lower(x), cat) OR starts_with(lower(x), 'let''s ') OR starts_with(lower(x), 'one more time')) AND regexp_matches(x, '{_PRE}') AND length(rest) >= 10 THEN rest ELSE x END AS clue FROM r""")
def preamble_strip(s, d):
    x = sql(s, d, f"SELECT doc_id, {_SELECTION} AS x, CASE WHEN doc_id % 8 = 0 THEN 'trees' ELSE 'zzz' END AS cat FROM {{documents}}")
    return x.select("doc_id", text.without_preamble(F.col("x"), F.col("cat")).alias("clue"))


_ANSWER = "CASE c_custkey % 9 WHEN 0 THEN 'Paris' WHEN 1 THEN 'the Beatles' WHEN 2 THEN 'electrons' WHEN 3 THEN 'grass' WHEN 4 THEN 'What''s a sink?' WHEN 5 THEN 'Charles Dickens' WHEN 6 THEN 'Paris?' WHEN 7 THEN ' ' ELSE c_name END"


@query("""SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'What is Paris?' WHEN 1 THEN 'Who are the Beatles?' WHEN 2 THEN 'What are electrons?' WHEN 3 THEN 'What is grass?' WHEN 4 THEN 'What''s a sink?'
 WHEN 5 THEN 'Who is Charles Dickens?' WHEN 6 THEN 'What is Paris?' WHEN 7 THEN ' ' ELSE 'What is ' || c_name || '?' END AS question FROM {customer}""")
def response_form(s, d):
    x = sql(s, d, f"SELECT c_custkey, {_ANSWER} AS a FROM {{customer}}")
    return x.select("c_custkey", text.question_form(F.col("a")).alias("question"))


@query("""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS w FROM {documents}), c AS (SELECT doc_id, w, len(regexp_extract_all(w, '[aeiouy]+')) AS n FROM w),
 t AS (SELECT doc_id, sum(greatest(1, n - CASE WHEN n > 1 AND ends_with(w, 'e') AND NOT ends_with(w, 'le') THEN 1 ELSE 0 END))::BIGINT AS k FROM c GROUP BY doc_id)
 SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k, 1) END AS syllables FROM {documents} d LEFT JOIN t ON t.doc_id = d.doc_id""")
def syllable_counts(s, d):
    return load_table(s, d, "documents").select("doc_id", text.syllables(F.col("text")).cast("long").alias("syllables"))


_WAGER = "CASE o_orderkey % 5 WHEN 0 THEN 'True Daily Double' WHEN 1 THEN CAST(o_custkey AS VARCHAR(20)) WHEN 2 THEN 'all of it' WHEN 3 THEN NULL ELSE ' 500 ' END"


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'True Daily Double' WHEN 1 THEN o_custkey::VARCHAR WHEN 4 THEN '500' END AS wager FROM {orders}")
def wager_parse(s, d):
    return sql(s, d, f"SELECT o_orderkey, {_WAGER} AS w FROM {{orders}}").select("o_orderkey", text.wager_amount(F.col("w")).alias("wager"))


@query("SELECT event_id, (event_id * 3)::INT AS line, 'L' || (event_id * 3) AS raw FROM {events} WHERE event_id % 4 < 2")
def line_id_parse(s, d):
    x = sql(s, d, "SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('L', CAST(event_id * 3 AS VARCHAR(20))) WHEN 1 THEN concat('[L', CAST(event_id * 3 AS VARCHAR(20)), ']') WHEN 2 THEN 'none' ELSE '' END AS l FROM {events}")
    return x.select("event_id", text.line_id(F.col("l")).alias("line")).filter("line IS NOT NULL").withColumn("raw", F.concat(F.lit("L"), F.col("line").cast("string")))


@query("SELECT event_type, count(*) AS n, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS total FROM {events} GROUP BY event_type")
def json_props(s, d):
    return load_table(s, d, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("SELECT o_orderkey, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0) ELSE printf('%.2f GB', n / 1073741824.0) END AS size, CASE WHEN o_custkey >= 3600 THEN printf('%d:%02d:%02d', o_custkey // 3600, o_custkey % 3600 // 60, o_custkey % 60) ELSE printf('%d:%02d', o_custkey // 60, o_custkey % 60) END AS duration FROM (SELECT *, o_orderkey * o_custkey % 7 * 300000000 + o_orderkey AS n FROM {orders}) x")
def display_formats(s, d):
    x = sql(s, d, "SELECT *, o_orderkey * o_custkey % 7 * 300000000 + o_orderkey AS n FROM {orders}")
    return x.select("o_orderkey", text.file_size(F.col("n")).alias("size"), text.duration(F.col("o_custkey")).alias("duration"))


@query("SELECT o_orderkey, least(5 * pow(2.0, o_orderkey % 8), 120.0) AS wait_s, o_orderkey % 3 = 0 AS retryable FROM {orders}")
def retry_backoff(s, d):
    x = sql(s, d, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN concat('code ', CASE WHEN o_orderkey % 2 = 0 THEN '429' ELSE 'UNAVAILABLE' END) ELSE 'bad input' END AS e FROM {orders}")
    return x.select("o_orderkey", text.backoff_seconds(F.col("o_orderkey") % 8).alias("wait_s"), text.is_retryable(F.col("e")).alias("retryable"))


# ---------------------------------------------------------------- vectors, sound, cost


@query("SELECT a.vec_id, round(least(1, greatest(0, 1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS distance FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(s, d):
    e = load_table(s, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", F.round(vector.cosine_distance(F.col("embedding"), F.col("other")), 6).alias("distance"))


@query("""WITH q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS e FROM {embeddings} WHERE vec_id % 50 = 0), x AS (SELECT qid, b.vec_id, round(least(1, greatest(0, 1 - list_cosine_similarity(q.e, b.embedding::DOUBLE[]))), 6) AS distance FROM q JOIN {embeddings} b ON b.vec_id <> q.qid)
 SELECT qid, vec_id, distance, place FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id) AS place FROM x) y WHERE place <= 5""")
def knn_topk(s, d):
    e = load_table(s, d, "embeddings").select("vec_id", "embedding")
    return vector.nearest(e.filter("vec_id % 50 = 0"), e, 5)


_SOUND = """WITH w AS (SELECT user_id AS episode, CASE event_id % 5 WHEN 0 THEN 'Um,' WHEN 1 THEN 'uh' ELSE event_type END AS word, (event_id % 100)::DOUBLE AS s, (event_id % 100 + 1)::DOUBLE AS e, ((event_id % 7) / 8)::DOUBLE AS p FROM {events}),
 b AS (SELECT DISTINCT user_id AS episode, (user_id % 50)::DOUBLE AS t0, (user_id % 50 + 20)::DOUBLE AS t1 FROM {events})
 SELECT b.episode, t0, t1, coalesce(round_even(avg(p) FILTER (WHERE s >= t0 AND e <= t1), 4), 0.0) AS confidence, count(*) FILTER (WHERE s >= t0 AND e <= t1 AND word IN ('Um,', 'uh')) AS disfluencies FROM b LEFT JOIN w ON w.episode = b.episode GROUP BY b.episode, t0, t1"""


@query(_SOUND)
def acoustic_metrics(s, d):
    w = sql(s, d, "SELECT user_id AS episode, CASE event_id % 5 WHEN 0 THEN 'Um,' WHEN 1 THEN 'uh' ELSE event_type END AS word, CAST(event_id % 100 AS DOUBLE) AS start, CAST(event_id % 100 + 1 AS DOUBLE) AS end, (event_id % 7) / 8D AS prob FROM {events}")
    b = sql(s, d, "SELECT DISTINCT user_id AS episode, CAST(user_id % 50 AS DOUBLE) AS t0, CAST(user_id % 50 + 20 AS DOUBLE) AS t1 FROM {events}")
    return timing.acoustics(b, w, ["episode"])


_PRICED = "CASE o_orderkey % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large' ELSE 'unknown' END"


@query(f"SELECT {_PRICED} AS model, count(*) AS n, round(sum((o_custkey * CASE o_orderkey % 4 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 2.0 ELSE 0 END + (o_orderkey % 900 + o_orderkey % 70) * CASE o_orderkey % 4 WHEN 0 THEN 1.5 WHEN 1 THEN 3.0 WHEN 2 THEN 12.0 ELSE 0 END) / 1e6), 6) AS cost FROM {{orders}} GROUP BY {_PRICED}")
def token_cost(s, d):
    usage = sql(s, d, f"SELECT {_PRICED} AS model, o_custkey AS input_tokens, o_orderkey % 900 AS output_tokens, o_orderkey % 70 AS thinking_tokens FROM {{orders}}")
    prices = s.createDataFrame([("small", 0.25, 1.5), ("medium", 0.5, 3.0), ("large", 2.0, 12.0)], "model string, price_in double, price_out double")
    return timing.token_cost(usage, prices).groupBy("model").agg(F.count("*").alias("n"), F.round(F.sum("cost_usd"), 6).alias("cost"))


# ---------------------------------------------------------------- names


_FIVE = "SELECT c_custkey // 5 AS episode, c_custkey AS seq, c_name AS name FROM {customer}"
_FIVE_IN_SPARK = _FIVE.replace(" // ", " DIV ")


@query(f"""WITH p AS ({_FIVE}), s AS (SELECT episode, seq, CASE seq % 3 WHEN 0 THEN substring(name, 2) WHEN 1 THEN upper(name) || 'x' ELSE 'zzzzzzzzzzzzzzzzzzzzzzzzzz' END AS speaker FROM p),
 x AS (SELECT s.episode, s.speaker, p.name, levenshtein(lower(s.speaker), lower(p.name)) AS d, row_number() OVER (PARTITION BY s.episode, s.speaker, s.seq ORDER BY levenshtein(lower(s.speaker), lower(p.name)), p.seq) AS r FROM s JOIN p ON p.episode = s.episode)
 SELECT DISTINCT episode, speaker, CASE WHEN d <= 3 THEN name END AS match, CASE WHEN d <= 3 THEN d END::INT AS distance FROM x WHERE r = 1""")
def name_fuzzy(s, d):
    people = sql(s, d, _FIVE_IN_SPARK)
    speaker = F.expr("CASE seq % 3 WHEN 0 THEN substring(name, 2) WHEN 1 THEN upper(name) || 'x' ELSE 'zzzzzzzzzzzzzzzzzzzzzzzzzz' END")
    return names.fuzzy(people.select("episode", speaker.alias("speaker")).distinct(), people)


_PEOPLE = "SELECT c_nationkey AS episode, c_custkey AS seq, concat(CASE c_custkey % 3 WHEN 0 THEN 'Ann ' WHEN 1 THEN 'Bo ' ELSE 'Cy ' END, 'L', CAST(c_custkey AS VARCHAR(20))) AS name FROM {customer}"


@query(f"""WITH p AS ({_PEOPLE}), v AS (SELECT episode, lower(name) AS variant, name FROM p UNION ALL SELECT episode, lower(string_split(name, ' ')[2]), name FROM p
 UNION ALL SELECT episode, lower(string_split(name, ' ')[1]) AS variant, max_by(name, seq) FROM p GROUP BY episode, lower(string_split(name, ' ')[1]) HAVING count(*) % 2 = 1) SELECT episode, variant, name FROM v""")
def name_parts_unique(s, d):
    return names.variants(sql(s, d, _PEOPLE))


_SAID = "CASE seq % 5 WHEN 0 THEN lower(name) WHEN 1 THEN substring(name, 10, 8) WHEN 2 THEN 'xqxqxqxqxqxqxqxqxqxqxqxqxq' WHEN 3 THEN name || '!' ELSE name || '?' END"


@query(f"""WITH p AS ({_FIVE}), a AS (SELECT episode, seq AS k, {_SAID} AS speaker, seq % 5 = 3 AS is_host FROM p),
 x AS (SELECT a.episode, a.speaker, a.k, a.is_host, min_by(name, seq) FILTER (WHERE lower(name) = lower(speaker)) AS e, min_by(name, seq) FILTER (WHERE contains(lower(name), lower(speaker))) AS c FROM a JOIN p ON p.episode = a.episode GROUP BY a.episode, a.speaker, a.k, a.is_host),
 f AS (SELECT a.episode, a.speaker, a.k, name, levenshtein(lower(speaker), lower(name)) AS d, row_number() OVER (PARTITION BY a.episode, a.k ORDER BY levenshtein(lower(speaker), lower(name)), p.seq) AS r FROM a JOIN p ON p.episode = a.episode)
 SELECT x.episode, x.speaker, x.k, coalesce(e, c, CASE WHEN d <= 3 AND NOT is_host THEN name END) AS who FROM x JOIN f ON f.episode = x.episode AND f.k = x.k AND f.r = 1 WHERE coalesce(e, c, CASE WHEN d <= 3 AND NOT is_host THEN name END) IS NOT NULL""")
def name_resolve(s, d):
    people = sql(s, d, _FIVE_IN_SPARK)
    a = people.select("episode", F.expr(_SAID).alias("speaker"), F.col("seq").alias("k"))
    hosts = a.filter("k % 5 = 3").select("episode", "speaker").distinct()
    return names.resolve(a, people, hosts).select("episode", "speaker", "k", "who")


# ---------------------------------------------------------------- tables and queue


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n FROM {lineitem}) x WHERE n = 1)
 SELECT * FROM n UNION ALL SELECT o_orderkey, 1, o_custkey, 0 FROM {orders} WHERE NOT EXISTS (SELECT 1 FROM n WHERE l_orderkey = o_orderkey AND l_linenumber = 1)""")
def upsert_latest(s, d):
    new = load_table(s, d, "lineitem").withColumn("_seq", F.struct("l_partkey", "l_suppkey", "l_quantity")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_seq")
    old = load_table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("o_custkey").alias("l_partkey"), F.lit(0).cast("long").alias("l_suppkey"))
    return tables.upsert(old, new, ["l_orderkey", "l_linenumber"])


@query("SELECT doc_id, quality FROM {labels} UNION ALL SELECT doc_id, -1 FROM {documents} d WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)")
def insert_ignore(s, d):
    old = load_table(s, d, "labels").select("doc_id", "quality")
    new = load_table(s, d, "documents").select("doc_id", F.lit(-1).cast(old.schema["quality"].dataType).alias("quality"))
    return tables.insert_ignore(old, new, ["doc_id"])[0]


@query("SELECT c_custkey, round(c_acctbal + coalesce(t, 0), 2) AS c_acctbal FROM {customer} LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS t FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey")
def additive_update(s, d):
    deltas = load_table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"))
    return tables.add(load_table(s, d, "customer").select("c_custkey", "c_acctbal"), deltas, "c_custkey").select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'patched' ELSE c_mktsegment END AS c_mktsegment FROM {customer}")
def partial_update(s, d):
    c = load_table(s, d, "customer").select("c_custkey", "c_mktsegment")
    change = c.filter("c_custkey % 4 < 2").select("c_custkey", F.when(F.col("c_custkey") % 4 == 1, "patched").alias("c_mktsegment"))
    return tables.patch(c, change, "c_custkey")


@query("""WITH c AS (SELECT conv_id AS episode, turn AS idx, text, role AS response FROM {conversations}),
 r AS (SELECT *, CASE idx % 4 WHEN 0 THEN 'corrected' WHEN 1 THEN 'verified' ELSE 'unverifiable' END AS st, CASE WHEN idx % 2 = 0 THEN text || '!' ELSE substring(text, 1, 30) END AS t FROM c)
 SELECT episode, idx, CASE WHEN (st = 'corrected' AND t <> text) OR (st = 'verified' AND length(t) >= 10 AND length(t) < length(text) AND t <> text) THEN t ELSE text END AS text, CASE WHEN st = 'corrected' AND response <> 'x' THEN 'x' ELSE response END AS response,
 CASE WHEN st = 'corrected' AND response <> 'x' THEN response END AS original_response, st IN ('corrected', 'verified') AS is_verified FROM r""")
def verify_merge(s, d):
    c = sql(s, d, "SELECT conv_id AS episode, turn AS idx, text, role AS response FROM {conversations}")
    i = F.col("idx") % 4
    r = c.select("episode", "idx", F.when(i == 0, "corrected").when(i == 1, "verified").otherwise("unverifiable").alias("status"), F.when(F.col("idx") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.substring("text", 1, 30)).alias("text"), F.lit("x").alias("response"))
    return tables.verified(c, r)


@query("SELECT id, CASE WHEN n = 1 THEN 'TRANSCRIBING' ELSE status END AS status FROM (SELECT *, CASE WHEN status = 'PENDING' THEN row_number() OVER (PARTITION BY status ORDER BY created_at, id) END AS n FROM {queue}) x")
def claim_oldest(s, d):
    return queue.claim(view(s, d, "queue"), "PENDING", "TRANSCRIBING")[0].select("id", "status")


@query("""SELECT id, CASE WHEN status <> 'TRANSCRIBING' THEN status WHEN retry_count >= 3 THEN 'FAILED' ELSE 'PENDING' END AS status,
 CASE WHEN status = 'TRANSCRIBING' AND retry_count < 3 THEN retry_count + 1 ELSE retry_count END AS retry_count, CASE WHEN status = 'TRANSCRIBING' THEN 500 END AS error_chars FROM {queue}""")
def retry_fold(s, d):
    q = view(s, d, "queue")
    f = q.filter("status = 'TRANSCRIBING'").select("id", F.lit("PENDING").alias("previous_status"), F.repeat(F.lit("e"), F.lit(600)).alias("error"))
    return queue.failed(q, f).select("id", "status", "retry_count", F.length("last_error").alias("error_chars"))


@query("SELECT id, CASE status WHEN 'FAILED' THEN 'PENDING' WHEN 'TRANSCRIBING' THEN 'PENDING' WHEN 'CLEANED' THEN 'TRANSCRIPT_READY' ELSE status END AS status, CASE WHEN status = 'FAILED' THEN 0 ELSE retry_count END AS retry_count FROM {queue}")
def crash_reset(s, d):
    return queue.reset_in_flight(queue.reset_failed(view(s, d, "queue"))).select("id", "status", "retry_count")


@query("SELECT id, status FROM {queue} WHERE status NOT IN ('COMPLETED', 'SAVING', 'MULTIMODAL_PROCESSING', 'MULTIMODAL_DONE', 'VECTORIZING')")
def stage_filter(s, d):
    return queue.open_for(view(s, d, "queue"), "extract").select("id", "status")


_HISTORY = "SELECT user_id AS id, event_id AS seq, CASE event_id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'TRANSCRIBING' ELSE 'TRANSCRIPT_READY' END AS status FROM {events}"


@query(f"WITH h AS (SELECT *, lag(status) OVER (PARTITION BY id ORDER BY seq) AS b FROM ({_HISTORY}) x) SELECT id, seq, b AS before, status FROM h WHERE b IS NOT NULL AND NOT (b = 'PENDING' AND status = 'TRANSCRIBING') AND NOT (b = 'TRANSCRIBING' AND status = 'TRANSCRIPT_READY')")
def status_transitions_illegal(s, d):
    return queue.illegal(sql(s, d, _HISTORY)).select("id", "seq", "before", "status")


@query("SELECT count_if(status IN ('PENDING', 'TRANSCRIBING')) AS depth, count_if(status IN ('PENDING', 'TRANSCRIBING')) = 0 AS drained FROM {queue}")
def drain_test(s, d):
    return queue.drained(view(s, d, "queue"), ["PENDING", "TRANSCRIBING"])


# ---------------------------------------------------------------- windows and streams


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS w_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM {events} GROUP BY ALL")
def tumbling_events(s, d):
    return windows.tumbling(load_table(s, d, "events"), "1 hour", ["event_type"])


@query("WITH e AS (SELECT event_type, value, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS w FROM {events}) SELECT w AS w_start, w + INTERVAL '1 hour' AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY ALL")
def sliding_events(s, d):
    return windows.sliding(load_table(s, d, "events"), "1 hour", "30 minutes", ["event_type"])


@query("WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS new FROM {events}), k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT min(ts) AS w_start, max(ts) + INTERVAL '2 hours' AS w_end, user_id, count(*) AS n, round(sum(value), 4) AS total FROM k GROUP BY user_id, k")
def session_events(s, d):
    return windows.sessions(load_table(s, d, "events"), "2 hours", ["user_id"])


# Records of nested brackets and escaped quotes, one after another, cut at any place. Braces and backslashes by number, as neither engine takes them as the other does.
_CUT = """SELECT conv_id, turn, left(concat(chr(123), '"clues": [', j, ', ', j, ' , ', j), CAST(greatest(12, (conv_id * 7919 + turn * 104729) % (3 * length(j) + 12)) AS INT)) AS t
 FROM (SELECT conv_id, turn, concat(chr(123), '"role":"', role, '", "n": [[], ', chr(123), chr(125), '], "text":"',
  replace(replace(text, chr(92), concat(chr(92), chr(92))), ',', concat(chr(92), '"', chr(92), chr(92), ',', chr(125), ']')), '"', chr(125)) AS j FROM {conversations}) x"""
# DuckDB's check walks over the characters, one state for each.
_STATE = "'e': false, 'q': false, 'i': 0, 'cut': 0, 's': ''"
_AUTOMATON = """list_reduce(list_prepend({'c': '', STATE}, list_transform(string_split(TEXT, ''), lambda ch: {'c': ch, STATE})),
 lambda a, r: {'c': '', 'e': NOT a.e AND r.c = chr(92), 'q': CASE WHEN a.e THEN a.q ELSE a.q <> (r.c = '"') END, 'i': a.i + 1,
 'cut': CASE WHEN NOT a.e AND NOT a.q AND r.c IN (chr(125), ']') THEN a.i + 1 ELSE a.cut END,
 's': CASE WHEN a.e OR a.q THEN a.s WHEN r.c IN (chr(123), '[') THEN a.s || r.c WHEN concat(right(a.s, 1), r.c) IN (chr(123) || chr(125), '[]') THEN left(a.s, len(a.s) - 1) ELSE a.s END})""".replace("STATE", _STATE)
_REPAIRED = """WITH c AS (SELECT *, regexp_replace(t, '\\s+$', '') AS b FROM (CUT) y), a AS (SELECT *, FIRST AS w FROM c),
 k AS (SELECT *, regexp_replace(regexp_replace(CASE WHEN w.cut > 0 THEN left(b, w.cut) ELSE b || CASE WHEN w.q THEN '"' ELSE '' END END, ',\\s*"[^"]*"\\s*:\\s*$', ''), ',\\s*$', '') AS u FROM a)
 SELECT conv_id, turn, md5(CASE WHEN right(b, 1) = chr(125) THEN t ELSE u || translate(reverse((SECOND).s), chr(123) || '[', chr(125) || ']') END) AS repaired FROM k
""".replace("CUT", _CUT).replace("FIRST", _AUTOMATON.replace("TEXT", "b")).replace("SECOND", _AUTOMATON.replace("TEXT", "u"))


@query(_REPAIRED)
def json_repair(s, d):
    """Records cut at any place, strings with escaped quotes and brackets in them."""
    x = sql(s, d, _CUT)
    return x.select("conv_id", "turn", F.md5(recover.repaired_json(F.col("t"))).alias("repaired"))


@query("SELECT c_custkey, 'Ann ' || chr((65 + c_custkey % 26)::INT) || 'x' AS name FROM {customer}")
def speaker_map_parse(s, d):
    name = F.concat(F.lit("Ann "), F.chr(65 + F.col("c_custkey") % 26), F.lit("x"))
    shapes = [
        F.concat(F.lit('{"SPEAKER_00": "'), "name", F.lit('"}')),
        F.concat(F.lit("{'SPEAKER_00': '"), "name", F.lit("'}")),
        F.concat(F.lit('{"mapping": {"SPEAKER_00": "'), "name", F.lit('"}, "host": "x"}')),
        F.concat(F.lit('[{"speaker": "SPEAKER_00", "name": "'), "name", F.lit('"}]')),
        F.concat(F.lit("The speakers are\nSPEAKER_00 -> "), "name", F.lit("\nand nobody else")),
        F.concat(F.lit('[{"speaker": "SPEAKER_09", "text": "Ann '), F.substring("name", 5, 9), F.lit('"}, {"speaker": "SPEAKER_09", "text": "and so on"}, {"speaker": "SPEAKER_00", "name": "'), "name", F.lit('"}]')),
    ]
    x = load_table(s, d, "customer").select("c_custkey", name.alias("name"))
    t = F.array(*shapes)[(F.col("c_custkey") % len(shapes)).cast("int")]
    return x.select("c_custkey", recover.parsed_speaker_map(t)["SPEAKER_00"].alias("name"))


from cluelake.plans import assembly, extra, joins, relational, streams, summaries  # noqa: E402, F401  they add to the register
