"""Chronological score replay: events, the fold over them, board control.

Inputs are long tables. clues: episode, pos, round, board_row, is_dd, wager
(text), wagerer. attempts: episode, pos, k, speaker, is_correct. contestants:
episode, who. adjustments: episode, who, points, after (a selection order).
finals: episode, who, wager, is_correct. The fold is partitioned by (episode,
contestant): a True Daily Double reads only its own player's score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRUE_DD = "True Daily Double"
LAST = 1_000_000


def face_value() -> Column:
    return F.col("board_row") * F.when(F.col("round") == "J!", 200).when(F.col("round") == "Double J!", 400).otherwise(0)


def is_dd_branch() -> Column:
    """Only with a wager and a wagerer is a Daily Double scored as one."""
    return F.col("is_dd") & F.col("wager").isNotNull() & (F.coalesce("wagerer", F.lit("")) != "")


def scored_attempts(clues: DataFrame, attempts: DataFrame, contestants: DataFrame) -> DataFrame:
    """Attempts of standard clues that count: of known speakers, up to the first correct one."""
    known = attempts.join(contestants.select("episode", F.col("who").alias("speaker")), ["episode", "speaker"], "left_semi")
    std = known.join(clues.filter(~F.coalesce(is_dd_branch(), F.lit(False))).select("episode", "pos", face_value().alias("face")), ["episode", "pos"])
    w = Window.partitionBy("episode", "pos").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return std.withColumn("done", F.coalesce(F.max(F.col("is_correct").cast("int")).over(w), F.lit(0))).filter("done = 0").drop("done")


def events(clues: DataFrame, attempts: DataFrame, contestants: DataFrame, adjustments: DataFrame, finals: DataFrame) -> DataFrame:
    """episode, who, pos, sub, kind (add, tdd+, tdd-), v, m, coryat."""
    sign = lambda c: F.when(c, 1).otherwise(-1)
    std = scored_attempts(clues, attempts, contestants)
    std = std.select("episode", F.col("speaker").alias("who"), "pos", F.col("k").cast("int").alias("sub"), F.lit("add").alias("kind"), (sign(F.col("is_correct")) * F.col("face")).cast("long").alias("v"), F.lit(0).alias("m"), (sign(F.col("is_correct")) * F.col("face")).cast("long").alias("coryat"))
    dd = clues.filter(is_dd_branch()).join(attempts.filter("k = 1").select("episode", "pos", "is_correct"), ["episode", "pos"])
    true = F.col("wager") == TRUE_DD
    dd = dd.select(
        "episode",
        F.col("wagerer").alias("who"),
        "pos",
        F.lit(0).alias("sub"),
        F.when(~true, "add").when(F.col("is_correct"), "tdd+").otherwise("tdd-").alias("kind"),
        F.coalesce(sign(F.col("is_correct")) * F.expr("try_cast(wager AS bigint)"), F.lit(0)).cast("long").alias("v"),
        F.when(F.col("round") == "Double J!", 2000).otherwise(1000).alias("m"),
        (sign(F.col("is_correct")) * face_value()).cast("long").alias("coryat"),
    )
    at = clues.groupBy("episode", F.col("selection_order").alias("after")).agg(F.min("pos").alias("pos"))
    adj = adjustments.join(at, ["episode", "after"]).select("episode", "who", "pos", F.lit(100).alias("sub"), F.lit("add").alias("kind"), F.col("points").cast("long").alias("v"), F.lit(0).alias("m"), F.lit(0).cast("long").alias("coryat"))
    fin = finals.join(contestants, ["episode", "who"], "left_semi").select("episode", "who", F.lit(LAST).cast(clues.schema["pos"].dataType).alias("pos"), F.lit(0).alias("sub"), F.lit("add").alias("kind"), (sign(F.col("is_correct")) * F.col("wager")).cast("long").alias("v"), F.lit(0).alias("m"), F.lit(0).cast("long").alias("coryat"))
    return std.unionByName(dd).unionByName(adj).unionByName(fin)


def _step(acc: Column, e: Column) -> Column:
    stake = F.greatest(acc, e["m"].cast("long"))
    return F.when(e["kind"] == "tdd+", acc + stake).when(e["kind"] == "tdd-", acc - stake).otherwise(acc + e["v"])


def _ordered() -> Column:
    return F.array_sort(F.collect_list(F.struct("pos", "sub", "kind", "v", "m")))


def scores(ev: DataFrame, contestants: DataFrame) -> DataFrame:
    """episode, who, final_score, coryat of every contestant, 0 without an event."""
    done = ev.groupBy("episode", "who").agg(F.aggregate(_ordered(), F.lit(0).cast("long"), _step).alias("final_score"), F.sum("coryat").alias("coryat"))
    out = contestants.select("episode", "who").join(done, ["episode", "who"], "left")
    return out.select("episode", "who", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("final_score", "coryat")])


def stakes(clues: DataFrame, ev: DataFrame) -> DataFrame:
    """episode, pos, stake of every True Daily Double, also of one without an attempt: its player's score before it, or the highest value of the round's board.

    Marks stand before the events of their clue; the fold keeps the score and a stake for each mark.
    """
    marks = clues.filter(is_dd_branch() & (F.col("wager") == TRUE_DD))
    marks = marks.select("episode", F.col("wagerer").alias("who"), "pos", F.lit(-1).alias("sub"), F.lit("mark").alias("kind"), F.lit(0).cast("long").alias("v"), F.when(F.col("round") == "Double J!", 2000).otherwise(1000).alias("m"))
    mine = ev.drop("coryat").join(marks.select("episode", "who").distinct(), ["episode", "who"], "left_semi")
    found = f"array<struct<pos:{ev.schema['pos'].dataType.simpleString()},stake:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("score"), F.array().cast(found).alias("found"))

    def step(acc: Column, e: Column) -> Column:
        mark = F.struct(e["pos"].alias("pos"), F.greatest(acc["score"], e["m"].cast("long")).alias("stake"))
        is_mark = e["kind"] == "mark"
        return F.struct(F.when(is_mark, acc["score"]).otherwise(_step(acc["score"], e)).alias("score"), F.when(is_mark, F.array_append(acc["found"], mark)).otherwise(acc["found"]).alias("found"))

    done = mine.unionByName(marks).groupBy("episode", "who").agg(F.aggregate(_ordered(), start, step, lambda acc: acc["found"]).alias("x"))
    return done.select("episode", F.explode("x").alias("x")).select("episode", "x.pos", "x.stake")


def running(ev: DataFrame) -> DataFrame:
    """episode, who, n, pos, score after each event: sums over a window, once True Daily Doubles have their stakes.

    The fold keeps a stake for each of these and nothing for other events, so
    that it doesn't copy an array at each step; the window needs no shuffle, as
    its keys are those of the fold.
    """
    found = f"array<struct<pos:{ev.schema['pos'].dataType.simpleString()},stake:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("score"), F.array().cast(found).alias("found"))

    def step(acc: Column, e: Column) -> Column:
        now = _step(acc["score"], e)
        mark = F.struct(e["pos"].alias("pos"), (now - acc["score"]).alias("stake"))
        return F.struct(now.alias("score"), F.when(e["kind"] == "add", acc["found"]).otherwise(F.array_append(acc["found"], mark)).alias("found"))

    g = ev.groupBy("episode", "who").agg(_ordered().alias("e"))
    g = g.withColumn("stakes", F.map_from_entries(F.aggregate("e", start, step, lambda acc: acc["found"])))
    x = g.select("episode", "who", "stakes", F.posexplode("e").alias("n", "x"))
    v = F.when(F.col("x.kind") == "add", F.col("x.v")).otherwise(F.try_element_at("stakes", F.col("x.pos")))
    x = x.select("episode", "who", (F.col("n") + 1).cast("long").alias("n"), F.col("x.pos").cast("long").alias("pos"), v.alias("v"))
    w = Window.partitionBy("episode", "who").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return x.select("episode", "who", "n", "pos", F.sum("v").over(w).alias("score"))


def control(clues: DataFrame, attempts: DataFrame, contestants: DataFrame) -> DataFrame:
    """episode, pos, before, holder: who controls the board before and after each clue; misses leave it."""
    right = scored_attempts(clues, attempts, contestants).filter("is_correct").select("episode", "pos", F.col("speaker").alias("got"))
    dd = clues.filter(is_dd_branch()).join(attempts.filter("k = 1 AND is_correct").select("episode", "pos"), ["episode", "pos"]).select("episode", "pos", F.col("wagerer").alias("got"))
    w = Window.partitionBy("episode").orderBy("pos")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    x = clues.select("episode", "pos").join(right.unionByName(dd), ["episode", "pos"], "left")
    return x.select("episode", "pos", F.last("got", ignorenulls=True).over(past).alias("before"), F.last("got", ignorenulls=True).over(w).alias("holder"))


def control_changes(holders: DataFrame) -> DataFrame:
    """episode, who, changes: how often each contestant takes control."""
    w = Window.partitionBy("episode").orderBy("pos")
    taken = holders.withColumn("before", F.lag("holder").over(w)).filter(F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("before")))
    return taken.groupBy("episode", F.col("holder").alias("who")).agg(F.count("*").alias("changes"))
