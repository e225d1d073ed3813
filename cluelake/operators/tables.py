"""Nested episodes to relational tables, key and constraint audits, and updates of tables by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cluelake.operators import replay
from cluelake.schemas import CONTRACTS

FINAL_ORDER = 61


def name_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, " ", "_"))


def contestant_key(episode: Column, name: Column) -> Column:
    return F.concat(episode, F.lit("_"), name_key(name))


def games(episodes: DataFrame) -> dict[str, DataFrame]:
    """The long tables that the replay takes (episode is episode_id) of nested episodes; pos and k are places in their lists, from 1."""
    e = F.col("episode_id").alias("episode")
    at = F.col("i").cast("long") + 1
    clue = episodes.select(e, F.posexplode("clues").alias("i", "c"))
    tried = clue.select("episode", at.alias("pos"), F.posexplode("c.attempts").alias("j", "a"))
    return {
        "clues": clue.select("episode", at.alias("pos"), "c.round", "c.board_row", F.col("c.is_daily_double").alias("is_dd"), F.col("c.daily_double_wager").alias("wager"), F.col("c.wagerer_name").alias("wagerer"), F.col("c.selection_order").cast("long").alias("selection_order")),
        "attempts": tried.select("episode", "pos", (F.col("j") + 1).cast("long").alias("k"), "a.speaker", "a.is_correct"),
        "contestants": episodes.select(e, F.explode("contestants").alias("c")).select("episode", F.col("c.name").alias("who")).distinct(),
        "adjustments": episodes.select(e, F.explode("score_adjustments").alias("a")).select("episode", F.col("a.contestant").alias("who"), F.col("a.points_adjusted").alias("points"), F.col("a.effective_after_clue_selection_order").cast("long").alias("after")),
        "finals": episodes.select(e, F.explode("final_jep.wagers_and_responses").alias("w")).select("episode", F.col("w.contestant").alias("who"), F.col("w.wager").cast("long").alias("wager"), "w.is_correct"),
    }


def replayed(episodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(episodes, scores): each game played through; True Daily Doubles have the stake that they came to, scores are for flatten()."""
    g = games(episodes)
    ev = replay.events(**g)
    scores = replay.scores(ev, g["contestants"]).select(F.col("episode").alias("episode_id"), F.col("who").alias("name"), "final_score", F.col("coryat").alias("coryat_score"))
    stake = replay.stakes(g["clues"], ev).groupBy("episode").agg(F.map_from_entries(F.collect_list(F.struct("pos", "stake"))).alias("_stakes"))
    x = episodes.join(stake.withColumnRenamed("episode", "episode_id"), "episode_id", "left")

    def put(c: Column, i: Column) -> Column:
        found = F.try_element_at("_stakes", (i + 1).cast("long")).cast("string")
        return c.withField("daily_double_wager", F.coalesce(found, c["daily_double_wager"]))

    return x.withColumn("clues", F.transform("clues", put)).drop("_stakes"), scores


def star(episodes: DataFrame) -> dict[str, DataFrame]:
    """The star of episodes as they were played."""
    return flatten(*replayed(episodes))


def flatten(episodes: DataFrame, scores: DataFrame | None = None) -> dict[str, DataFrame]:
    """The star of episodes (episode_id and the EPISODE columns). scores: episode_id, name, final_score, coryat_score; 0 where absent.

    Rows of contestants that aren't among the episode's are dropped from
    buzz_attempts, wagers and score_adjustments; equal keys keep the last.
    """
    e = F.col("episode_id")
    people = episodes.select("episode_id", F.posexplode("contestants").alias("i", "c"))
    people = people.select("episode_id", "i", "c.*", contestant_key(e, F.col("c.name")).alias("contestant_id"))
    contestants = last(people, ["contestant_id"], "i")
    clue = episodes.select("episode_id", F.posexplode("clues").alias("i", "c")).select("episode_id", "i", "c.*", F.concat(e, F.lit("_c"), F.col("c.selection_order").cast("string")).alias("clue_id"))
    stumper = ~F.exists(F.coalesce("attempts", F.array().cast(dict(clue.dtypes)["attempts"])), lambda a: F.coalesce(a["is_correct"], F.lit(False)))
    clues = last(clue.withColumn("is_triple_stumper", stumper), ["clue_id"], "i")
    buzz = clue.select("episode_id", "clue_id", "host_finish_timestamp_ms", F.posexplode("attempts").alias("j", "a"))
    buzz = buzz.select("episode_id", "clue_id", F.concat("clue_id", F.lit("_a"), F.col("a.attempt_order").cast("string")).alias("attempt_id"), contestant_key(e, F.col("a.speaker")).alias("contestant_id"), "j", "a.*", (F.col("a.buzz_timestamp_ms") - F.col("host_finish_timestamp_ms")).alias("true_buzzer_latency_ms"))
    dd = clue.filter(F.col("is_daily_double") & F.col("daily_double_wager").isNotNull() & (F.coalesce("wagerer_name", F.lit("")) != ""))
    dd = dd.select("episode_id", "clue_id", F.concat("clue_id", F.lit("_dd")).alias("wager_id"), contestant_key(e, F.col("wagerer_name")).alias("contestant_id"), F.coalesce(F.expr("try_cast(daily_double_wager AS int)"), F.lit(-1)).alias("actual_wager"), F.lit(0).alias("j"))
    fj = F.concat(e, F.lit("_fj"))
    fin = episodes.filter("final_jep IS NOT NULL").select("episode_id", fj.alias("clue_id"), F.posexplode("final_jep.wagers_and_responses").alias("j", "w"))
    fin_w = fin.select("episode_id", "clue_id", F.concat("clue_id", F.lit("_"), name_key(F.col("w.contestant"))).alias("wager_id"), contestant_key(e, F.col("w.contestant")).alias("contestant_id"), F.col("w.wager").alias("actual_wager"), "j")
    fin_b = fin.select("episode_id", "clue_id", F.concat("clue_id", F.lit("_a"), (F.col("j") + 1).cast("string")).alias("attempt_id"), contestant_key(e, F.col("w.contestant")).alias("contestant_id"), "j", F.lit(1).alias("attempt_order"), F.col("w.contestant").alias("speaker"), F.col("w.response").alias("response_given"), F.col("w.is_correct").alias("is_correct"), F.lit(0.0).alias("buzz_timestamp_ms"), F.lit(0.0).alias("response_start_timestamp_ms"), F.lit(False).alias("is_lockout_inferred"), F.lit(0.0).alias("true_buzzer_latency_ms"))
    fin_c = episodes.filter("final_jep IS NOT NULL").select("episode_id", fj.alias("clue_id"), F.lit("Final J!").alias("round"), F.col("final_jep.category").alias("category"), F.lit(FINAL_ORDER).alias("selection_order"), F.lit(False).alias("is_daily_double"), F.lit(0.0).alias("host_start_timestamp_ms"), F.lit(0.0).alias("host_finish_timestamp_ms"), F.lit(0).alias("clue_syllable_count"), F.col("final_jep.clue_text").alias("clue_text"), F.when(F.col("final_jep.correct_response") != "", F.col("final_jep.correct_response")).alias("correct_response"), F.lit(False).alias("is_verified"), F.lit(False).alias("requires_visual_context"), (~F.exists("final_jep.wagers_and_responses", lambda w: w["is_correct"])).alias("is_triple_stumper"))
    adj = episodes.select("episode_id", F.posexplode("score_adjustments").alias("j", "a")).select("episode_id", F.concat(e, F.lit("_adj_"), F.col("a.effective_after_clue_selection_order").cast("string"), F.lit("_"), name_key(F.col("a.contestant"))).alias("adjustment_id"), contestant_key(e, F.col("a.contestant")).alias("contestant_id"), "j", "a.*")
    perf = contestants.select("episode_id", "contestant_id", "name", "podium_position")
    if scores is not None:
        perf = perf.join(scores, ["episode_id", "name"], "left")
    for c in ("final_score", "coryat_score"):
        perf = perf.withColumn(c, F.coalesce(F.col(c) if scores is not None else F.lit(None), F.lit(0)).cast("int"))
    keep = lambda d: d.join(contestants.select("contestant_id"), "contestant_id", "left_semi")
    return {
        "episodes": episodes.select("episode_id", F.col("episode_date").alias("air_date"), "host_name", "is_tournament"),
        "contestants": contestants.select("contestant_id", "name", "occupational_category", "is_returning_champion"),
        "episode_performances": perf.drop("name"),
        "clues": clues.drop("attempts", "i").unionByName(fin_c, allowMissingColumns=True),
        "buzz_attempts": last(keep(buzz.unionByName(fin_b)), ["attempt_id"], "j").drop("j"),
        "wagers": last(keep(dd.unionByName(fin_w)), ["wager_id"], "j").drop("j"),
        "score_adjustments": last(keep(adj), ["adjustment_id"], "j").drop("j"),
    }


def last(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).filter("_n = 1").drop("_n")


def violations(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """rule, n: how many rows of a table break each part of its contract."""
    c, t = CONTRACTS[name], tables[name]
    aggs = [F.count_if(F.col(x).isNull()).alias(f"{x} is null") for x in c.required]
    aggs += [F.count_if(~F.coalesce(F.expr(x), F.lit(True))).alias(f"not {x}") for x in c.checks]
    aggs += [(F.count("*") - F.count_distinct(*c.key)).alias(f"repeated {', '.join(c.key)}")]
    one = t.agg(*aggs)
    out = one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("rule"), F.col(f"`{x}`").cast("long").alias("n")) for x in one.columns])).alias("r")).select("r.*")
    for col, (other, key) in c.foreign.items():
        lost = t.filter(F.col(col).isNotNull()).join(tables[other].select(F.col(key).alias(col)), col, "left_anti")
        out = out.unionByName(lost.agg(F.lit(f"{col} not in {other}").alias("rule"), F.count("*").alias("n")))
    return out


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace rows of old with their key; the last of equal keys in new (by _seq, if it has one) wins."""
    n = last(new, keys, "_seq").drop("_seq") if "_seq" in new.columns else new
    return old.join(n.select(*keys), keys, "left_anti").unionByName(n)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(all rows, rows that were new)."""
    fresh = new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh), fresh


def patch(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Sets the columns that changes has, for its keys, nulls included; keys that old lacks become rows. Unknown columns are an error."""
    unknown = sorted(set(changes.columns) - set(old.columns))
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    c = changes.select(*[F.col(x).alias(f"_{x}") for x in changes.columns]).withColumn("_set", F.lit(True))
    j = old.join(c, F.col(key) == F.col(f"_{key}"), "full_outer")
    return j.select(*[F.coalesce(key, f"_{key}").alias(x) if x == key else F.when(F.col("_set"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) if x in changes.columns else F.col(x) for x in old.columns])


def add(old: DataFrame, deltas: DataFrame, key: str) -> DataFrame:
    """Adds the columns of deltas, taking nulls as 0."""
    cols = [c for c in deltas.columns if c != key]
    d = deltas.groupBy(key).agg(*[F.sum(c).alias(f"_{c}") for c in cols])
    j = old.join(d, key, "left")
    touched = F.col(f"_{cols[0]}").isNotNull()
    return j.select(*[F.when(touched, F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in old.columns])


def verified(clues: DataFrame, results: DataFrame) -> DataFrame:
    """Verification merged into clues (episode, idx, text, response) by (episode, idx); results: status, text, response. Results that no clue has are dropped."""
    r = results.select("episode", "idx", "status", F.col("text").alias("t"), F.col("response").alias("r"))
    x = clues.join(r, ["episode", "idx"], "left")
    fix, ok = F.col("status") == "corrected", F.col("status") == "verified"
    new_t, new_r = F.col("t").isNotNull() & (F.col("t") != F.col("text")), F.col("r").isNotNull() & (F.col("r") != F.col("response"))
    shorter = ok & (F.length("t") >= 10) & new_t & (F.length("t") < F.length("text"))
    return x.select(
        "episode",
        "idx",
        F.when((fix & new_t) | shorter, F.col("t")).otherwise(F.col("text")).alias("text"),
        F.when(fix & new_r, F.col("r")).otherwise(F.col("response")).alias("response"),
        F.when(fix & new_r, F.col("response")).alias("original_response"),
        F.coalesce(ok | (fix & (new_t | new_r)), F.lit(False)).alias("is_verified"),
    )


def insert(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with whole rows of new; columns that one has and the other lacks are an error."""
    if set(old.columns) != set(new.columns):
        raise ValueError(f"other columns: {', '.join(sorted(set(old.columns) ^ set(new.columns)))}")
    return old.unionByName(new)


def correction_summary(corrections: DataFrame) -> DataFrame:
    """One row of counts of corrections (field, correction_type)."""
    field, kind = F.col("field"), F.col("correction_type")
    # Names of fields and of kinds of corrections.
    named = [("clue_text", field == "clue_text"), ("correct_response", field == "correct_response"), ("typo", kind == "typo")]
    named += [("preamble_stripped", kind == "preamble_stripped"), ("response_fixed", kind == "response_fixed"), ("major", kind == "major")]
    return corrections.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"n_{name}") for name, cond in named])


def verified_final(finals: DataFrame, results: DataFrame) -> DataFrame:
    """finals (episode, response) with the response of a result (episode, r) in its place, whatever that result's status, unless it is null."""
    x = finals.join(results.select("episode", F.col("r").alias("_r")), "episode", "left")
    return x.withColumn("response", F.coalesce("_r", "response")).drop("_r")
