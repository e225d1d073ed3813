"""Resolution of speakers to contestants: exact, by a part of the name, by containment, by edit distance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_DISTANCE = 3


def fuzzy(speakers: DataFrame, contestants: DataFrame, most: int = MAX_DISTANCE) -> DataFrame:
    """speakers (episode, speaker) with match and distance: the nearest contestant (episode, seq, name) by full name or part, ties to the first.

    The join is within an episode, whose contestants are few.
    """
    low = F.trim(F.lower(F.col("name")))
    c = contestants.select("episode", "seq", "name", F.posexplode(F.array_prepend(F.filter(F.split(low, r"\s+"), lambda p: F.length(p) > 1), low)).alias("i", "cand"))
    x = speakers.join(c, "episode", "left").withColumn("d", F.levenshtein(F.trim(F.lower(F.col("speaker"))), F.col("cand")))
    best = x.groupBy("episode", "speaker").agg(F.min(F.when(F.col("d") <= most, F.struct("d", "seq", "i", "name"))).alias("b"))
    return best.select("episode", "speaker", F.col("b.name").alias("match"), F.col("b.d").alias("distance"))


def variants(contestants: DataFrame) -> DataFrame:
    """episode, variant, name: full names, and parts of two letters or more that lead to one contestant.

    A part of several names leads to none; where an odd number of contestants
    share it, removing and adding in turn leaves it with the last.
    """
    low = F.lower(F.col("name"))
    full = contestants.select("episode", low.alias("variant"), "seq", "name", F.lit(True).alias("whole"))
    part = contestants.select("episode", F.explode(F.array_distinct(F.transform(F.split(low, r"\s+"), lambda p: F.regexp_replace(p, r"\.+$", "")))).alias("variant"), "seq", "name", F.lit(False).alias("whole"))
    x = full.unionByName(part.filter(F.length("variant") > 1)).groupBy("episode", "variant").agg(F.array_sort(F.collect_list(F.struct((~F.col("whole")).alias("part"), "seq", "name"))).alias("h"))
    none = F.lit(None).cast("string")
    step = lambda a, e: F.when(a.isNull(), e["name"]).when(~e["part"] | (a == e["name"]), F.when(e["part"], a).otherwise(e["name"])).otherwise(none)
    return x.select("episode", "variant", F.aggregate("h", none, step).alias("name")).filter(F.col("name").isNotNull())


def resolve(attempts: DataFrame, contestants: DataFrame, hosts: DataFrame) -> DataFrame:
    """attempts (episode, speaker) with who: by variant, by containment in a name (the first), by edit distance; hosts (episode, speaker) and the others are dropped."""
    s = attempts.select("episode", "speaker").distinct()
    v = variants(contestants).withColumnRenamed("name", "by_variant")
    exact = s.withColumn("variant", F.lower("speaker")).join(v, ["episode", "variant"], "left").drop("variant")
    inside = exact.join(contestants.select("episode", "seq", "name"), "episode", "left").withColumn("inside", F.lower("name").contains(F.lower("speaker")))
    held = inside.groupBy("episode", "speaker", "by_variant").agg(F.min_by(F.when(F.col("inside"), F.col("name")), F.when(F.col("inside"), F.col("seq"))).alias("by_part"))
    out = held.join(fuzzy(s, contestants), ["episode", "speaker"], "left").join(hosts.withColumn("is_host", F.lit(True)), ["episode", "speaker"], "left")
    out = out.withColumn("who", F.coalesce("by_variant", "by_part", F.when(F.col("is_host").isNull(), F.col("match")))).filter("who IS NOT NULL")
    return attempts.join(out.select("episode", "speaker", "who"), ["episode", "speaker"])


def reconcile(mapping: DataFrame, contestants: DataFrame, hosts: list[str]) -> DataFrame:
    """mapping (episode, id, name) with resolved: a contestant by exact name, a known host as is, a contestant that holds the name, the nearest one, else the name itself."""
    m = mapping.withColumn("low", F.trim(F.lower("name")))
    c = contestants.select("episode", F.col("seq").alias("cseq"), F.col("name").alias("cname"))
    near = fuzzy(mapping.select("episode", F.col("name").alias("speaker")).distinct(), contestants).select("episode", F.col("speaker").alias("name"), "match")
    x = m.join(c, "episode", "left").groupBy("episode", "id", "name", "low").agg(
        F.max(F.when(F.trim(F.lower("cname")) == F.col("low"), F.col("cname"))).alias("exact"),
        F.min(F.when(F.lower("cname").contains(F.col("low")), F.struct("cseq", "cname"))).alias("held"),
    )
    x = x.join(near, ["episode", "name"], "left")
    host = F.col("low").isin(*[h.lower() for h in hosts]) if hosts else F.lit(False)
    return x.select("episode", "id", "name", F.coalesce("exact", F.when(host, F.col("name")), "held.cname", "match", "name").alias("resolved"))


def lookup(mapping: DataFrame, contestants: DataFrame, hosts: DataFrame) -> DataFrame:
    """episode, variant, name: variants() with the speaker ids and names of a mapping (episode, seq, id, name) that isn't the host's (episode, host).

    A mapped name leads to a contestant by variant, by its first word that is
    one, or by containment in a name (the first); an id whose name leads to none
    leads to the mapped name itself. SPEAKER_01 is also s01 and s1. Of equal
    ids the last counts, of equal names the first.
    """
    v = variants(contestants)
    low = F.lower("name")
    m = mapping.join(hosts.select("episode", F.lower(F.trim("host")).alias("host")), "episode", "left")
    m = m.filter(~F.lower(F.trim("name")).eqNullSafe(F.col("host"))).select("episode", "seq", F.lower("id").alias("id"), "name", low.alias("low"))
    words = F.filter(F.transform(F.split(F.col("low"), r"\s+"), lambda p: F.regexp_replace(p, r"\.+$", "")), lambda p: F.length(p) > 1)
    tries = m.select("episode", "seq", "id", F.posexplode(F.array_prepend(words, F.col("low"))).alias("i", "variant"))
    direct = tries.join(v.withColumnRenamed("name", "to"), ["episode", "variant"]).groupBy("episode", "seq", "id").agg(F.min_by("to", "i").alias("direct"))
    c = contestants.select("episode", F.col("seq").alias("cseq"), F.col("name").alias("cname"))
    held = m.join(c, "episode").filter(F.lower("cname").contains(F.col("low"))).groupBy("episode", "seq", "id").agg(F.min_by("cname", "cseq").alias("held"))
    m = m.join(direct, ["episode", "seq", "id"], "left").join(held, ["episode", "seq", "id"], "left").withColumn("to", F.coalesce("direct", "held"))
    n = F.regexp_extract("id", r"^speaker_(\d+)$", 1)
    short = F.when(n != "", F.array(F.concat(F.lit("s"), n), F.concat(F.lit("s"), n.try_cast("int").cast("string")), F.concat(F.lit("s"), F.lpad(n.try_cast("int").cast("string"), 2, "0")))).otherwise(F.array().cast("array<string>"))
    ids = m.select("episode", F.explode(F.array_distinct(F.array_prepend(short, F.col("id")))).alias("variant"), "seq", F.coalesce("to", "name").alias("name"))
    ids = ids.groupBy("episode", "variant").agg(F.max_by("name", "seq").alias("name"))
    own = m.filter("to IS NOT NULL").groupBy("episode", F.col("low").alias("variant")).agg(F.min_by("to", "seq").alias("name"))
    more = own.join(v, ["episode", "variant"], "left_anti").join(ids, ["episode", "variant"], "left_anti")
    return v.join(ids, ["episode", "variant"], "left_anti").unionByName(ids).unionByName(more)


def swept(speakers: DataFrame, mapping: DataFrame, contestants: DataFrame, hosts: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """speakers (episode, speaker) with soft and who: the name by lookup or containment, and the contestant that is left after the sweep.

    soft is the speaker itself where nothing is found. The sweep keeps
    contestants, drops the host with all ids, takes the nearest contestant by
    edit distance, and else leaves who null: such an attempt goes. Names of
    wagers and adjustments take coalesce(who, speaker). found: what lookup() gives, if it is there already.
    """
    s = speakers.select("episode", "speaker").distinct()
    found = (found or lookup(mapping, contestants, hosts)).withColumnRenamed("name", "by_variant")
    x = s.withColumn("variant", F.lower("speaker")).join(found, ["episode", "variant"], "left").drop("variant")
    c = contestants.select("episode", "seq", F.col("name").alias("cname"))
    inside = x.join(c, "episode", "left").withColumn("inside", F.lower("cname").contains(F.lower("speaker")))
    x = inside.groupBy("episode", "speaker", "by_variant").agg(F.min_by(F.when(F.col("inside"), F.col("cname")), F.when(F.col("inside"), F.col("seq"))).alias("by_part"))
    x = x.select("episode", "speaker", F.coalesce("by_variant", "by_part", "speaker").alias("soft"))
    own = contestants.select("episode", F.lower("name").alias("low"), F.col("name").alias("exact"))
    host = hosts.select("episode", F.lower(F.trim("host")).alias("low"))
    of_host = mapping.join(host, "episode").filter(F.lower(F.trim("name")) == F.col("low")).select("episode", F.lower("id").alias("id"))
    n = F.regexp_extract("id", r"^speaker_(\d+)$", 1)
    num = n.try_cast("int").cast("string")
    ids = of_host.select("episode", F.explode(F.when(n != "", F.array(F.col("id"), F.concat(F.lit("s"), n), F.concat(F.lit("s"), num), F.concat(F.lit("s"), F.lpad(num, 2, "0")))).otherwise(F.array("id"))).alias("low"))
    host = host.union(ids).distinct().withColumn("is_host", F.lit(True))
    near = fuzzy(x.select("episode", F.col("soft").alias("speaker")).distinct(), contestants).select("episode", F.col("speaker").alias("soft"), "match")
    x = x.withColumn("low", F.lower("soft")).join(own, ["episode", "low"], "left").join(host, ["episode", "low"], "left").join(near, ["episode", "soft"], "left")
    return x.select("episode", "speaker", "soft", F.coalesce("exact", F.when(F.col("is_host").isNull(), F.col("match"))).alias("who"))


def canonical(speakers: DataFrame, found: DataFrame, contestants: DataFrame) -> DataFrame:
    """speakers (episode, speaker) with name: by lookup (found), else the nearest contestant, else the speaker itself. For wagers, corrections and Finals."""
    s = speakers.select("episode", "speaker").distinct()
    found = found.withColumnRenamed("name", "by_variant")
    x = s.withColumn("variant", F.lower("speaker")).join(found, ["episode", "variant"], "left").join(fuzzy(s, contestants), ["episode", "speaker"], "left")
    return x.select("episode", "speaker", F.coalesce("by_variant", "match", "speaker").alias("name"))


def _map(rows: DataFrame, value: str, name: str) -> DataFrame:
    """episode and a map of an episode's speakers: a few dozen."""
    return rows.filter(F.col("speaker").isNotNull() & F.col(value).isNotNull()).groupBy("episode").agg(F.map_from_entries(F.collect_list(F.struct("speaker", value))).alias(name))


def swept_games(episodes: DataFrame, mapping: DataFrame, hosts: DataFrame, store: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """Nested episodes with one spelling of each name in attempts, wagerers, corrections and Finals, and n_dropped: the attempts that no contestant made.

    mapping (episode, seq, id, name) and hosts (episode, host) as for lookup();
    episode is episode_id. Attempts are swept; the other names take what
    canonical() finds. An attempt without a speaker goes. Names are resolved
    once for each episode and put back into the arrays by maps. store writes a
    table and reads it back: what both kinds of names look up is made once then.
    """
    e = F.col("episode_id").alias("episode")
    people = episodes.select(e, F.posexplode("contestants.name").alias("seq", "name"))
    clue = episodes.select(e, F.explode("clues").alias("c"))
    said = clue.select("episode", F.explode("c.attempts.speaker").alias("speaker"))
    others = clue.select("episode", F.col("c.wagerer_name").alias("speaker")).filter("speaker <> ''")
    others = others.union(episodes.select(e, F.explode("score_adjustments.contestant"))).union(episodes.select(e, F.explode("final_jep.wagers_and_responses.contestant")))
    found = store(lookup(mapping, people, hosts))
    who = _map(store(swept(said, mapping, people, hosts, found)), "who", "_who")
    name = _map(store(canonical(others, found, people)), "name", "_name")
    maps = who.join(name, "episode", "full_outer").withColumnRenamed("episode", "episode_id")
    x = episodes.join(maps, "episode_id", "left")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    x = x.withColumns({"_who": F.coalesce("_who", none), "_name": F.coalesce("_name", none)})
    of = lambda c: F.coalesce(F.try_element_at("_name", c), c)
    known = lambda a: F.map_contains_key("_who", F.coalesce(a["speaker"], F.lit("")))
    tries = lambda c: F.transform(F.filter(c["attempts"], known), lambda a: a.withField("speaker", F.element_at("_who", a["speaker"])))
    count = lambda clues: F.aggregate(clues, F.lit(0), lambda n, c: n + F.greatest(F.size(c["attempts"]), F.lit(0)))
    new = F.transform("clues", lambda c: c.withField("attempts", tries(c)).withField("wagerer_name", of(c["wagerer_name"])))
    fixes = F.transform("score_adjustments", lambda a: a.withField("contestant", of(a["contestant"])))
    wagers = F.transform("final_jep.wagers_and_responses", lambda w: w.withField("contestant", of(w["contestant"])))
    final = F.when(F.col("final_jep").isNotNull(), F.col("final_jep").withField("wagers_and_responses", wagers))
    x = x.withColumn("_new", new).withColumn("n_dropped", (F.coalesce(count("clues"), F.lit(0)) - F.coalesce(count("_new"), F.lit(0))).cast("long"))
    x = x.withColumns({"clues": F.col("_new"), "score_adjustments": fixes, "final_jep": final})
    return x.select(*episodes.columns, "n_dropped")


def hosts(episodes: DataFrame, mapping: DataFrame, known: DataFrame, default: str) -> DataFrame:
    """episode, host: a known host (seq, host) as it is; else the first mapped name (episode, id, name) that is one, or a word of one; else the default.

    known is a dimension of a few rows.
    """
    k = F.broadcast(known.withColumn("low", F.lower("host")))
    own = episodes.select("episode", F.trim(F.lower("host_name")).alias("low")).join(k, "low").select("episode", F.col("host").alias("own"))
    m = mapping.withColumn("name_low", F.trim(F.lower("name")))
    hit = m.join(k, (F.col("name_low") == F.col("low")) | F.array_contains(F.split("low", " "), F.col("name_low")))
    hit = hit.groupBy("episode").agg(F.min(F.struct("id", F.col("name_low") != F.col("low"), "seq", "host")).alias("h"))
    x = episodes.select("episode").join(own, "episode", "left").join(hit, "episode", "left")
    return x.select("episode", F.coalesce("own", "h.host", F.lit(default)).alias("host"))


def mapped_to_known(mapping: DataFrame, contestants: DataFrame, host: DataFrame) -> DataFrame:
    """mapping (episode, id, name) where the name is the host's (episode, host) or a contestant's."""
    low = lambda c: F.trim(F.lower(c))
    ok = contestants.select("episode", low("name").alias("low")).union(host.select("episode", low("host"))).distinct()
    return mapping.withColumn("low", low("name")).join(ok, ["episode", "low"], "left_semi").drop("low")
