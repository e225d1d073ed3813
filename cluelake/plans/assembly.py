"""Queries on how clues are put together from a transcript and model output: text, times, rows, names, verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from cluelake.functions import board, text, timing, vector
from cluelake.operators import names, tables, transcript
from cluelake.plans.bindings import sql, view
from cluelake.plans.registry import query
from cluelake.schemas import EPISODE
from cluelake.sources import commit
from cluelake.sources.io import load_table
from cluelake.streaming import queue

# ---------------------------------------------------------------- text and times


@query("SELECT episode, regexp_replace(speaker, '^SPEAKER_', 'S') AS short, max_by(speaker, pos) AS speaker FROM {segments} WHERE starts_with(speaker, 'SPEAKER_') GROUP BY ALL")
def speaker_abbreviations(s, d):
    return transcript.speaker_ids(view(s, d, "segments"))


@query("SELECT episode, pos, round FROM {clues} WHERE round <> 'Double J!'")
def round_filter(s, d):
    """The Final's clues leave the extraction; on the given tables the second round stands for it."""
    last = F.col("round") == "Double J!"
    x = view(s, d, "clues").withColumn("round", F.when(last, "Final J!").otherwise(F.col("round")))
    return transcript.without_final(x).select("episode", "pos", "round")


_TOLD = "CASE pos % 3 WHEN 0 THEN text WHEN 1 THEN ' short ' END"
_TRIM = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"


_PRE = text.PREAMBLE.replace("'", "''")
_HEARD_AS = "SELECT episode, pos, CASE WHEN pos % 4 = 0 THEN concat('Trees for $400. ', text) WHEN pos % 4 = 2 THEN concat(' ', text, ' ') ELSE text END AS text FROM {segments}"


@query(f"""WITH s AS ({_HEARD_AS}), c AS (SELECT episode, pos AS key, greatest(0, pos - 2) AS first, CASE WHEN pos % 5 = 3 THEN greatest(0, pos - 2) ELSE pos END AS last, {_TRIM.format(f"coalesce({_TOLD}, '')")} AS own FROM {{segments}}),
 j AS (SELECT c.episode, c.key, string_agg({_TRIM.format('s.text')}, ' ' ORDER BY s.pos) AS t FROM c JOIN s ON s.episode = c.episode AND s.pos BETWEEN c.first AND c.last GROUP BY c.episode, c.key),
 h AS (SELECT c.*, {_TRIM.format("coalesce(t, '')")} AS t FROM c LEFT JOIN j ON j.episode = c.episode AND j.key = c.key),
 r AS (SELECT *, {_TRIM.format(f"regexp_replace(t, '{_PRE}', '')")} AS rest FROM h)
 SELECT episode, key, CASE WHEN length(own) >= 10 THEN own WHEN (starts_with(lower(t), 'trees') OR starts_with(lower(t), 'let''s ') OR starts_with(lower(t), 'one more time')) AND regexp_matches(t, '{_PRE}') AND length(rest) >= 10 THEN rest ELSE t END AS text FROM r""")
def clue_text_source(s, d):
    """What was said or, where that is missing or short, the transcript's text without the announcement; some ends lie before their start."""
    seg = sql(s, d, _HEARD_AS)
    last = F.when(F.col("pos") % 5 == 3, F.lit(-1)).otherwise(F.col("pos"))
    c = view(s, d, "segments").select("episode", F.col("pos").alias("key"), F.greatest(F.lit(0), F.col("pos") - 2).alias("first"), last.alias("last"), F.expr(_TOLD).alias("said"), F.lit("Trees").alias("category"))
    return transcript.spliced(c, seg).select("episode", "key", "text")


@query("""SELECT a.episode, a.pos AS key, CASE WHEN a.pos > 0 THEN string_agg(s.text, ' ' ORDER BY s.pos) END AS announced FROM {segments} a
 JOIN {segments} s ON s.episode = a.episode AND s.pos BETWEEN a.pos - 2 AND a.pos GROUP BY a.episode, a.pos""")
def selection_context(s, d):
    seg = view(s, d, "segments")
    return transcript.selection_context(seg.select("episode", F.col("pos").alias("key"), F.col("pos").alias("first")), seg).select("episode", "key", "announced")


@query("""SELECT a.episode, a.pos AS first, string_agg(concat('L', s.pos, ' [', s.speaker, ']: ', regexp_replace(regexp_replace(s.text, '^\\s+', ''), '\\s+$', ''),
 CASE WHEN s.pos = a.pos THEN ' ◄ CLUE START' ELSE '' END, CASE WHEN s.pos = a.pos + 1 THEN ' ◄ CLUE END' ELSE '' END), chr(10) ORDER BY s.pos) AS context
 FROM {segments} a JOIN {segments} s ON s.episode = a.episode AND s.pos BETWEEN a.pos - 3 AND a.pos + 9 GROUP BY a.episode, a.pos""")
def clue_context(s, d):
    seg = view(s, d, "segments")
    return transcript.clue_context(seg.select("episode", F.col("pos").alias("first"), (F.col("pos") + 1).alias("last")), seg).select("episode", "first", "context")


@query("""WITH b AS (SELECT *, lag(start_ms) OVER (PARTITION BY episode ORDER BY pos) AS b FROM (SELECT episode, pos, start_ms % 7000 AS start_ms FROM {segments}) x)
 SELECT episode, count(*) AS n, count_if(start_ms < b - 500) AS n_back, count_if(start_ms < b - 500) < count(*) * 0.02 AS ok FROM b GROUP BY episode""")
def monotonic_verdict(s, d):
    return transcript.monotonic(view(s, d, "segments").withColumn("start_ms", F.col("start_ms") % 7000))


_SAYS = "CASE pos % 4 WHEN 0 THEN 'for $' WHEN 1 THEN 'Trees for ' WHEN 2 THEN 'the score is $' ELSE 'take $' END"


@query(f"""WITH x AS (SELECT episode, pos, round, raw_row, {_SAYS} || (pos % 13 * 100) AS t FROM {{clues}}),
 v AS (SELECT *, CASE WHEN pos % 4 <> 2 AND (pos % 4 <> 1 OR pos % 13 > 0) AND pos % 13 * 100 IN ({", ".join(map(str, text.CLUE_VALUES))}) THEN pos % 13 * 100 END AS v, CASE round WHEN 'J!' THEN [200, 400, 600, 800, 1000] ELSE [400, 800, 1200, 1600, 2000] END AS g FROM x),
 n AS (SELECT *, list_transform(g, lambda q: abs(q - v)) AS dist, least(5, greatest(1, raw_row)) AS f FROM v)
 SELECT episode, pos, CASE WHEN v IS NULL THEN f WHEN list_min(dist) <= 100 THEN list_position(dist, list_min(dist)) ELSE f END::INT AS board_row FROM n""")
def announced_row(s, d):
    x = sql(s, d, f"SELECT episode, pos, round, raw_row, concat({_SAYS}, CAST(pos % 13 * 100 AS VARCHAR(20))) AS t FROM {{clues}}")
    return x.select("episode", "pos", board.announced_row(F.col("t"), F.col("round"), F.col("raw_row")).cast("int").alias("board_row"))


@query("""WITH b AS (SELECT a.episode, a.pos, a.k, c.finish_ms, try_cast(CASE (ok + a.k) % 3 WHEN 0 THEN '' ELSE a.pos::VARCHAR END AS INT) AS line, a.k % 2 = 0 AS lockout FROM {attempts} a JOIN {clues} c ON c.episode = a.episode AND c.pos = a.pos),
 t AS (SELECT b.*, CASE WHEN line IS NULL THEN finish_ms ELSE coalesce(s.start_ms, 0.0) END AS buzz_ms FROM b LEFT JOIN (SELECT episode, pos, CASE WHEN pos % 5 > 0 THEN start_ms END AS start_ms FROM {clues}) s ON s.episode = b.episode AND s.pos = b.line)
 SELECT episode, pos, k, buzz_ms, buzz_ms + 250 + CASE WHEN lockout THEN 250 ELSE 0 END AS response_ms, 0.0::DOUBLE AS freeze_ms FROM t""")
def buzz_times(s, d):
    x = sql(s, d, "SELECT a.episode, a.pos, a.k, c.finish_ms, CASE (ok + a.k) % 3 WHEN 0 THEN 'L' ELSE concat('L', CAST(a.pos AS VARCHAR(20))) END AS line_id, a.k % 2 = 0 AS lockout FROM {attempts} a JOIN {clues} c ON c.episode = a.episode AND c.pos = a.pos")
    seg = sql(s, d, "SELECT episode, pos AS line, CASE WHEN pos % 5 > 0 THEN start_ms / 1000 END AS start FROM {clues}")
    x = x.withColumn("line", text.line_id(F.col("line_id"))).join(seg, ["episode", "line"], "left")
    x = x.withColumn("buzz_ms", timing.buzz_start(timing.milliseconds(F.col("start")), F.col("line").isNotNull(), F.col("finish_ms")))
    x = x.withColumn("response_ms", timing.response_start(F.col("buzz_ms"), F.col("lockout")))
    return x.select("episode", "pos", "k", F.round("buzz_ms", 3).alias("buzz_ms"), F.round("response_ms", 3).alias("response_ms"), timing.brain_freeze(F.col("response_ms"), F.col("buzz_ms"), F.col("lockout")).alias("freeze_ms"))


@query("""SELECT o_orderkey, round_even((o_orderkey % 97 + o_custkey % 89) / 64 - o_orderkey % 97 / 64, 3) AS latency_s, CASE WHEN length(o_orderpriority || o_orderkey || repeat('e', (o_orderkey % 50)::INT)) > 40 THEN substring(o_orderpriority || o_orderkey || repeat('e', (o_orderkey % 50)::INT), 1, 37) || '...'
 ELSE o_orderpriority || o_orderkey || repeat('e', (o_orderkey % 50)::INT) END AS error, CASE WHEN o_orderkey % 2 = 0 THEN 'S' || (o_orderkey % 40) || 'E' || (o_custkey % 99) ELSE substring('a long name without a number ' || o_orderkey, 1, 20) END AS short_id,
 CASE WHEN length(o_orderkey::VARCHAR) > 3 THEN substring('key-' || o_orderkey, 1, 4) || repeat('•', 12) || right('key-' || o_orderkey, 4) WHEN length('key-' || o_orderkey) > 8 THEN NULL ELSE repeat('•', length('key-' || o_orderkey)) END AS secret FROM (SELECT * REPLACE (o_orderkey + 100000 AS o_orderkey) FROM {orders}) x""")
def display_values(s, d):
    x = sql(s, d, "SELECT o_orderkey + 100000 AS o_orderkey, o_custkey, o_orderpriority FROM {orders}")
    k = F.col("o_orderkey")
    light = (k % 97) / 64
    name = F.when(k % 2 == 0, F.concat(F.lit("Season 1 S"), (k % 40).cast("string"), F.lit("E"), (F.col("o_custkey") % 99).cast("string"), F.lit(" x"))).otherwise(F.concat(F.lit("a long name without a number "), k.cast("string")))
    error = F.concat("o_orderpriority", k.cast("string"), F.repeat(F.lit("e"), (k % 50).cast("int")))
    return x.select("o_orderkey", timing.buzzer_latency(light + (F.col("o_custkey") % 89) / 64, light).alias("latency_s"), text.short_error(error).alias("error"), text.short_id(name).alias("short_id"), text.masked(F.concat(F.lit("key-"), k.cast("string"))).alias("secret"))


@query("SELECT count(*) AS n, count_if(c_custkey % 9 IN (0, 1, 2, 3, 5, 6, 8)) AS n_fixed FROM {customer}")
def response_fixes(s, d):
    answer = "CASE c_custkey % 9 WHEN 0 THEN 'Paris' WHEN 1 THEN 'the Beatles' WHEN 2 THEN 'electrons' WHEN 3 THEN 'grass' WHEN 4 THEN 'What''s a sink?' WHEN 5 THEN 'Charles Dickens' WHEN 6 THEN 'Paris?' WHEN 7 THEN ' ' ELSE c_name END"
    return sql(s, d, f"SELECT {answer} AS a FROM {{customer}}").agg(F.count("*").alias("n"), text.fixed_responses(F.col("a")).alias("n_fixed"))


# ---------------------------------------------------------------- categories, vectors


@query("""WITH k AS (SELECT conv_id, list_slice(['a', 'b', 'c', 'd', 'e', 'f', 'g'], 1, (1 + conv_id % 7)::INT) AS known, list_slice(['p', 'q', 'r', 's', 't', 'u'], 1, (1 + conv_id * 3 % 6)::INT) AS seen FROM (SELECT DISTINCT conv_id FROM {conversations}) x)
 SELECT conv_id, array_to_string(CASE WHEN len(known) < 6 AND len(seen) > len(known) THEN seen ELSE known END, ',') AS categories FROM k""")
def category_merge(s, d):
    x = load_table(s, d, "conversations").select("conv_id").distinct()
    of = lambda letters, n: F.slice(F.array(*map(F.lit, letters)), F.lit(1), n.cast("int"))
    merged = board.merged_categories(of("abcdefg", 1 + F.col("conv_id") % 7), of("pqrstu", 1 + F.col("conv_id") * 3 % 6))
    return x.select("conv_id", F.array_join(merged, ",").alias("categories"))


@query("""WITH d AS (SELECT a.label, CAST(round(least(1, greatest(0, 1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))) * 1e6) AS BIGINT) AS micro FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1)
 SELECT label, count(*) AS n, round(sum(micro)::DOUBLE / count(*) / 1e6, 6) AS distance FROM d GROUP BY label ORDER BY distance DESC, label LIMIT 10""")
def lateral_by_category(s, d):
    """Mean semantic distance of clue and answer by category, the ten largest; a vector and the next one stand for both."""
    e = load_table(s, d, "embeddings")
    answer = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    x = e.join(answer, "vec_id").select("label", F.round(vector.cosine_distance(F.col("embedding"), F.col("other")) * 1e6).cast("long").alias("micro"))
    x = x.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum("micro").cast("double") / F.count("*") / 1e6, 6).alias("distance"))
    return x.orderBy(F.desc("distance"), "label").limit(10)


# ---------------------------------------------------------------- names

_CAST = "SELECT c_custkey // 4 AS episode, c_custkey % 4 AS seq, CASE c_custkey % 4 WHEN 0 THEN 'Rachel Ba' WHEN 1 THEN 'Scott R' WHEN 2 THEN 'W. Kamau B' ELSE 'Dan D' END || (c_custkey // 4) AS name FROM {customer}"
_WHO = "CASE c_custkey % 4 WHEN 0 THEN 'SPEAKER_00' WHEN 1 THEN 'SPEAKER_01' WHEN 2 THEN 'SPEAKER_02' ELSE 'SPEAKER_03' END"
_MAPPED = f"SELECT c_custkey // 4 AS episode, c_custkey % 4 AS seq, {_WHO} AS id, CASE c_custkey % 4 WHEN 0 THEN 'Ken Host' WHEN 1 THEN 'Scott' WHEN 2 THEN 'Mr. Kamau' ELSE 'Stranger' END AS name FROM {{customer}}"
_HEARD = ("rachel", "S01", "s1", "S00", "SPEAKER_02", "Rachael", "XYZ_MYSTERY_PLAYER", "Kamau", "mr. kamau", "S3", "ken host", "Dan")


def _cast(s, d):
    in_spark = lambda t: sql(s, d, t.replace(" // ", " DIV ").replace("|| (c_custkey DIV 4)", "|| CAST(c_custkey DIV 4 AS STRING)"))
    people, mapping = in_spark(_CAST), in_spark(_MAPPED)
    return people, mapping, people.select("episode", F.lit("Ken Host").alias("host")).distinct()


_LOOKUP = """WITH e AS (SELECT c_custkey // 4 AS e, bool_or(c_custkey % 4 = 0) AS r, bool_or(c_custkey % 4 = 1) AS s, bool_or(c_custkey % 4 = 2) AS k, bool_or(c_custkey % 4 = 3) AS d FROM {customer} GROUP BY c_custkey // 4),
 x AS (SELECT e AS episode, unnest([CASE WHEN r THEN ['rachel ba' || e, 'Rachel Ba' || e] END, CASE WHEN r THEN ['rachel', 'Rachel Ba' || e] END, CASE WHEN r THEN ['ba' || e, 'Rachel Ba' || e] END,
  CASE WHEN s THEN ['scott r' || e, 'Scott R' || e] END, CASE WHEN s THEN ['scott', 'Scott R' || e] END, CASE WHEN s THEN ['r' || e, 'Scott R' || e] END, CASE WHEN s THEN ['speaker_01', 'Scott R' || e] END, CASE WHEN s THEN ['s01', 'Scott R' || e] END, CASE WHEN s THEN ['s1', 'Scott R' || e] END,
  CASE WHEN k THEN ['w. kamau b' || e, 'W. Kamau B' || e] END, CASE WHEN k THEN ['kamau', 'W. Kamau B' || e] END, CASE WHEN k THEN ['b' || e, 'W. Kamau B' || e] END, CASE WHEN k THEN ['mr. kamau', 'W. Kamau B' || e] END, CASE WHEN k THEN ['speaker_02', 'W. Kamau B' || e] END, CASE WHEN k THEN ['s02', 'W. Kamau B' || e] END, CASE WHEN k THEN ['s2', 'W. Kamau B' || e] END,
  CASE WHEN d THEN ['dan d' || e, 'Dan D' || e] END, CASE WHEN d THEN ['dan', 'Dan D' || e] END, CASE WHEN d THEN ['d' || e, 'Dan D' || e] END, CASE WHEN d THEN ['speaker_03', 'Stranger'] END, CASE WHEN d THEN ['s03', 'Stranger'] END, CASE WHEN d THEN ['s3', 'Stranger'] END]) AS v FROM e)
 SELECT episode, v[1] AS variant, v[2] AS name FROM x WHERE v IS NOT NULL"""


@query(_LOOKUP)
def name_lookup(s, d):
    people, mapping, hosts = _cast(s, d)
    return names.lookup(mapping, people, hosts)


@query("""WITH e AS (SELECT c_custkey // 4 AS e FROM {customer} GROUP BY c_custkey // 4 HAVING count(*) = 4), x AS (SELECT e AS episode, unnest([['rachel', 'Rachel Ba' || e], ['S01', 'Scott R' || e], ['s1', 'Scott R' || e], ['S00', NULL], ['SPEAKER_02', 'W. Kamau B' || e],
  ['Rachael', 'Rachel Ba' || e], ['XYZ_MYSTERY_PLAYER', NULL], ['Kamau', 'W. Kamau B' || e], ['mr. kamau', 'W. Kamau B' || e], ['S3', NULL], ['ken host', NULL], ['Dan', 'Dan D' || e]]) AS v FROM e)
 SELECT episode, v[1] AS speaker, v[2] AS who FROM x""")
def name_sweep(s, d):
    people, mapping, hosts = _cast(s, d)
    full = people.groupBy("episode").agg(F.count("*").alias("n")).filter("n = 4").select("episode")
    heard = full.select("episode", F.explode(F.array(*map(F.lit, _HEARD))).alias("speaker"))
    return names.swept(heard, mapping, people.join(full, "episode", "left_semi"), hosts).select("episode", "speaker", "who")


_SHOWS = "SELECT c_custkey AS episode, CASE c_custkey % 4 WHEN 0 THEN ' ann LEE ' WHEN 1 THEN 'Nobody' WHEN 2 THEN NULL ELSE '' END AS host_name FROM {customer}"
_SPOKE = """SELECT c_custkey AS episode, 'SPEAKER_00' AS id, CASE c_custkey % 3 WHEN 0 THEN 'Bo' WHEN 1 THEN ' ann lee' ELSE 'Zed' END AS name FROM {customer}
 UNION ALL SELECT c_custkey, 'SPEAKER_01', CASE WHEN c_custkey % 5 = 0 THEN 'CY BO' ELSE 'c' END FROM {customer}"""
_HOST = "CASE WHEN c_custkey % 4 = 0 THEN 'Ann Lee' WHEN c_custkey % 3 = 0 THEN 'Cy Bo' WHEN c_custkey % 3 = 1 THEN 'Ann Lee' WHEN c_custkey % 5 = 0 THEN 'Cy Bo' ELSE 'Whoever' END"


def _hosts(s, d):
    known = s.createDataFrame([(0, "Ann Lee"), (1, "Cy Bo")], "seq int, host string")
    return names.hosts(sql(s, d, _SHOWS), sql(s, d, _SPOKE), known, "Whoever")


@query(f"SELECT c_custkey AS episode, {_HOST} AS host FROM {{customer}}")
def host_override(s, d):
    """The host as stated, else as the mapping has one of the known hosts, else the default."""
    return _hosts(s, d)


@query(f"""WITH m AS ({_SPOKE}), h AS (SELECT c_custkey AS episode, {_HOST} AS host FROM {{customer}}) SELECT m.episode, m.id, m.name FROM m JOIN h ON h.episode = m.episode WHERE lower(trim(m.name)) = lower(h.host) OR lower(trim(m.name)) = 'zed'""")
def known_speakers(s, d):
    """Mapped names that are the host's or a contestant's."""
    people = sql(s, d, "SELECT c_custkey AS episode, ' ZED' AS name FROM {customer}")
    return names.mapped_to_known(sql(s, d, _SPOKE), people, _hosts(s, d)).select("episode", "id", "name")


@query(f"""WITH people AS ({_CAST}), m AS ({_MAPPED}), cand AS (SELECT episode, seq, name, list_prepend(lower(name), list_filter(string_split(lower(name), ' '), lambda p: length(p) > 1)) AS ways, unnest(range(0, 9)) AS i FROM people),
 parts AS (SELECT episode, seq, name, i, ways[i + 1] AS part FROM cand WHERE i < len(ways)),
 near AS (SELECT episode, id, to_name FROM (SELECT m.episode, m.id, p.name AS to_name, row_number() OVER (PARTITION BY m.episode, m.id ORDER BY levenshtein(lower(m.name), part), p.seq, i) AS n FROM m JOIN parts p ON p.episode = m.episode AND levenshtein(lower(m.name), part) <= 3) x WHERE n = 1),
 held AS (SELECT m.episode, m.id, arg_min(p.name, p.seq) AS to_name FROM m JOIN people p ON p.episode = m.episode AND contains(lower(p.name), lower(m.name)) GROUP BY m.episode, m.id)
 SELECT m.episode, m.id, CASE WHEN m.name = 'Ken Host' THEN m.name ELSE coalesce(h.to_name, n.to_name, m.name) END AS resolved FROM m LEFT JOIN held h ON h.episode = m.episode AND h.id = m.id LEFT JOIN near n ON n.episode = m.episode AND n.id = m.id""")
def reconciled_names(s, d):
    """Mapped names as the contestants spell them."""
    people, mapping, _ = _cast(s, d)
    return names.reconcile(mapping, people, ["Ken Host"]).select("episode", "id", "resolved")


_KINDS = ("attempt", "wagerer", "correction", "final")


def _named_games(s, d):
    """Nested episodes in which every name of _HEARD stands in each of the four places, for all casts, whole or not."""
    people, mapping, hosts = _cast(s, d)
    shape = dict(s.createDataFrame([], EPISODE).dtypes)
    heard = F.array(*map(F.lit, _HEARD))
    cast = people.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("seq", "name"))).alias("c"))
    to = lambda kind, **c: F.from_json(F.to_json(F.struct(*[v.alias(k) for k, v in c.items()])), kind)
    one = lambda column: shape[column][len("array<") : -1]
    clues = F.transform(heard, lambda h: to(one("clues"), wagerer_name=h, attempts=F.transform(heard, lambda x: F.struct(x.alias("speaker")))))
    x = cast.select(
        F.col("episode").cast("string").alias("episode_id"), F.transform("c", lambda p: to(one("contestants"), name=p["name"])).alias("contestants"), F.slice(clues, 1, len(_HEARD)).alias("clues"),
        to(shape["final_jep"], wagers_and_responses=F.transform(heard, lambda h: F.struct(h.alias("contestant")))).alias("final_jep"), F.transform(heard, lambda h: to(one("score_adjustments"), contestant=h)).alias("score_adjustments"),
    )
    text = lambda df: df.withColumn("episode", F.col("episode").cast("string"))
    return x, text(mapping), text(hosts)


@query(f"""WITH look AS ({_LOOKUP}), people AS ({_CAST}), heard AS (SELECT unnest([{", ".join(f"'{h}'" for h in _HEARD)}]) AS h), asked AS (SELECT DISTINCT episode, h FROM people, heard),
 cand AS (SELECT episode, seq, name, unnest(range(0, 9)) AS i, list_prepend(lower(name), list_filter(string_split(lower(name), ' '), lambda p: length(p) > 1)) AS ways FROM people),
 parts AS (SELECT episode, seq, name, i, ways[i + 1] AS part FROM cand WHERE i < len(ways)),
 soft AS (SELECT a.*, coalesce(l.name, c.name, a.h) AS soft, l.name AS by_look FROM asked a LEFT JOIN look l ON l.episode = a.episode AND l.variant = lower(a.h)
  LEFT JOIN (SELECT a.episode, h, arg_min(name, seq) AS name FROM asked a JOIN people p ON p.episode = a.episode AND contains(lower(name), lower(h)) GROUP BY a.episode, h) c ON c.episode = a.episode AND c.h = a.h),
 ask AS (SELECT episode, h AS q FROM soft UNION SELECT episode, soft FROM soft),
 near AS (SELECT episode, q, name FROM (SELECT k.episode, q, name, row_number() OVER (PARTITION BY k.episode, q ORDER BY levenshtein(lower(q), part), seq, i) AS n FROM ask k JOIN parts p ON p.episode = k.episode AND levenshtein(lower(q), part) <= 3) x WHERE n = 1),
 hosts AS (SELECT DISTINCT episode, 'ken host' AS h FROM people UNION SELECT episode, unnest(['speaker_00', 's00', 's0']) FROM people WHERE seq = 0),
 who AS (SELECT s.episode, s.h, coalesce(e.name, CASE WHEN o.h IS NULL THEN n.name END) AS name FROM soft s LEFT JOIN people e ON e.episode = s.episode AND lower(e.name) = lower(soft)
  LEFT JOIN hosts o ON o.episode = s.episode AND o.h = lower(soft) LEFT JOIN near n ON n.episode = s.episode AND n.q = soft),
 other AS (SELECT s.episode, s.h, coalesce(by_look, n.name, s.h) AS name FROM soft s LEFT JOIN near n ON n.episode = s.episode AND n.q = s.h)
 SELECT episode, 'attempt' AS kind, name, count(*) * {len(_HEARD)} AS n FROM who WHERE name IS NOT NULL GROUP BY episode, name UNION ALL SELECT episode, 'dropped', NULL, count(*) * {len(_HEARD)} FROM who WHERE name IS NULL GROUP BY episode
 UNION ALL SELECT episode, kind, name, count(*) FROM other, (SELECT unnest({list(_KINDS[1:])}) AS kind) k GROUP BY episode, kind, name""")
def names_in_games(s, d):
    """Names in attempts, wagerers, corrections and Finals of nested episodes, made one, and the attempts that go."""
    x = commit.stored(names.swept_games(*_named_games(s, d), store=lambda t: commit.stored(t, "names")), "named-games")
    e = F.col("episode_id").cast("bigint").alias("episode")
    clue = x.select(e, F.explode("clues").alias("c"))
    found = {
        "attempt": clue.select("episode", F.explode("c.attempts.speaker").alias("name")), "wagerer": clue.select("episode", F.col("c.wagerer_name").alias("name")),
        "correction": x.select(e, F.explode("score_adjustments.contestant").alias("name")), "final": x.select(e, F.explode("final_jep.wagers_and_responses.contestant").alias("name")),
    }
    out = x.filter("n_dropped > 0").select(e, F.lit("dropped").alias("kind"), F.lit(None).cast("string").alias("name"), F.col("n_dropped").alias("n"))
    for kind in _KINDS:
        out = out.unionByName(found[kind].groupBy("episode", "name").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind)))
    return out


# ---------------------------------------------------------------- verification, queue, telemetry

_FIELD = "CASE turn % 2 WHEN 0 THEN 'clue_text' ELSE 'correct_response' END"
_KIND = "CASE (turn + conv_id) % 5 WHEN 0 THEN 'typo' WHEN 1 THEN 'preamble_stripped' WHEN 2 THEN 'response_fixed' WHEN 3 THEN 'major' END"


@query(f"""SELECT count(*) AS total, count_if(f = 'clue_text') AS n_clue_text, count_if(f = 'correct_response') AS n_correct_response, count_if(k = 'typo') AS n_typo, count_if(k = 'preamble_stripped') AS n_preamble_stripped,
 count_if(k = 'response_fixed') AS n_response_fixed, count_if(k = 'major') AS n_major FROM (SELECT {_FIELD} AS f, {_KIND} AS k FROM {{conversations}}) x""")
def verification_summary(s, d):
    return tables.correction_summary(sql(s, d, f"SELECT {_FIELD} AS field, {_KIND} AS correction_type FROM {{conversations}}"))


@query("SELECT episode, CASE episode % 3 WHEN 0 THEN 'new' ELSE 'old' END AS response FROM (SELECT DISTINCT episode FROM {clues}) x")
def verify_final(s, d):
    e = view(s, d, "clues").select("episode").distinct()
    results = e.filter("episode % 3 < 2").select("episode", F.when(F.col("episode") % 3 == 0, "new").alias("r"), F.lit("unverifiable").alias("status"))
    return tables.verified_final(e.withColumn("response", F.lit("old")), results)


@query("""SELECT stage, count(*) AS n FROM {queue}, (VALUES ('transcribe', ['TRANSCRIPT_READY', 'CLEANED', 'SAVING', 'MULTIMODAL_PROCESSING', 'MULTIMODAL_DONE', 'VECTORIZING', 'COMPLETED']), ('extract', ['SAVING', 'MULTIMODAL_PROCESSING', 'MULTIMODAL_DONE', 'VECTORIZING', 'COMPLETED']),
 ('augment', ['MULTIMODAL_DONE', 'VECTORIZING', 'COMPLETED']), ('verify', ['COMPLETED'])) t(stage, done) WHERE NOT list_contains(done, status) GROUP BY stage""")
def stages_open(s, d):
    """How many rows each active stage still has to do: a stage's complete statuses hold those of every later one."""
    q = view(s, d, "queue")
    each = [queue.open_for(q, stage).agg(F.lit(stage).alias("stage"), F.count("*").alias("n")) for stage in queue.ACTIVE["all"]]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


@query("SELECT count(*) AS n, sum(coalesce(tokens_in, 0))::BIGINT AS tokens_in, count_if(tokens_in IS NULL) + count(*) AS rows_seen FROM {telemetry}")
def telemetry_insert(s, d):
    t = view(s, d, "telemetry").select("id", "tokens_in")
    both = tables.insert(t, t.select((-1 - F.col("id")).alias("id"), F.lit(None).cast("bigint").alias("tokens_in")))
    return both.agg(F.count_if(F.col("id") >= 0).alias("n"), F.sum("tokens_in").alias("tokens_in"), (F.count_if((F.col("id") >= 0) & F.col("tokens_in").isNull()) + F.count_if(F.col("id") < 0)).alias("rows_seen"))
