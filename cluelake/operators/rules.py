"""Integrity rules as long-format warnings (episode, rule, subject, weight), and the quality gate.

clues: episode, pos, selection_order, round, category, board_row, board_col,
is_dd, wager (text), start_ms, finish_ms, text, response. attempts: episode,
pos, k, speaker, buzz_ms. contestants: episode, who. finals and adjustments:
episode, who. episodes: episode. Names and categories compare without case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.operators.ordered import overlaps, repeated_rows, strip

ROUNDS = ("J!", "Double J!")
LEAST_CLUES, MOST_WEIGHT = 45, 3.0


def warnings(episodes: DataFrame, clues: DataFrame, attempts: DataFrame, contestants: DataFrame, finals: DataFrame, adjustments: DataFrame) -> DataFrame:
    none = F.lit("")
    out = []

    def emit(rule: str, df: DataFrame, subject: Column = none, weight: float = 1.0) -> None:
        out.append(df.select("episode", F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), F.lit(weight).alias("weight")))

    per = clues.groupBy("episode").agg(
        *[F.count_if(F.col("round") == r).alias(f"n{i}") for i, r in enumerate(ROUNDS)],
        *[F.count_if((F.col("round") == r) & F.col("is_dd")).alias(f"dd{i}") for i, r in enumerate(ROUNDS)],
        F.count_if(strip(F.coalesce("text", F.lit(""))) == "").alias("v22"),
        F.count_if(strip(F.coalesce("response", F.lit(""))) == "").alias("v23"),
        F.count_if(F.col("finish_ms") < F.col("start_ms")).alias("v24"),
        F.count_if((F.col("selection_order") > 3) & (F.col("start_ms") == 0)).alias("v25"),
        F.count_if(F.col("finish_ms") - F.col("start_ms") > 60000).alias("v26"),
    )
    def emit_each(df: DataFrame, found: list[tuple[str, Column, Column]]) -> None:
        """Rules (rule, condition, subject) that are told from a row of df alone: one pass for all."""
        hit = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(rule).alias("rule"), subject.cast("string").alias("subject"))) for rule, cond, subject in found])
        x = df.select("episode", F.explode(F.array_compact(hit)).alias("r"))
        out.append(x.select("episode", "r.rule", "r.subject", F.lit(1.0).alias("weight")))

    emit("V1", episodes.join(contestants, "episode", "left_anti"))
    emit("V2", episodes.join(clues, "episode", "left_anti"))
    by_episode = [("V10", F.expr("dd0 + dd1 > 3"), none), ("V11", F.expr("dd0 > 1"), F.lit(ROUNDS[0])), ("V12", F.expr("dd1 > 2"), F.lit(ROUNDS[1]))]
    for i, (many, zero, few) in enumerate((("V3", "V5", "V6"), ("V4", "V7", "V8"))):
        r = F.lit(ROUNDS[i])
        by_episode += [(many, F.col(f"n{i}") > 30, r), (zero, F.col(f"n{i}") == 0, r), (few, F.col(f"n{i}").between(1, 14), r)]
    by_episode += [(v.upper(), F.col(v) > 0, F.col(v)) for v in ("v22", "v23", "v24", "v25", "v26")]
    emit_each(per, by_episode)
    emit("V9", overlaps(clues.withColumn("seq", F.col("pos"))), F.col("pos"))
    tries = attempts.groupBy("episode", "pos").agg(F.count("*").alias("tries"))
    dd = clues.filter("is_dd")
    emit("V13", dd.join(tries.filter("tries > 1"), ["episode", "pos"]), F.col("pos"))
    amount = F.expr("try_cast(wager AS bigint)")
    on_board = F.col("round").isin(*ROUNDS)
    of_clue = [("V14", F.col("is_dd") & (amount <= 0)), ("V15", F.col("is_dd") & (amount > 50000)), ("V19", on_board & ~F.col("board_row").between(1, 5)), ("V20", on_board & ~F.col("board_col").between(1, 6))]
    emit_each(clues, [(rule, cond, F.col("pos")) for rule, cond in of_clue])
    known = contestants.select("episode", strip("who").alias("name")).distinct()
    has_names = clues.select("episode").distinct().join(contestants.select("episode").distinct(), "episode", "left_semi")

    def unknown(df: DataFrame, col: str) -> DataFrame:
        return df.join(has_names, "episode", "left_semi").withColumn("name", strip(col)).join(known, ["episode", "name"], "left_anti")

    emit("V16", unknown(attempts, "speaker").select("episode").distinct())
    emit("V17", unknown(finals, "who"), F.col("name"))
    emit("V18", unknown(adjustments, "who"), F.col("name"))
    board = clues.filter(on_board)
    emit("V21", repeated_rows(board.withColumns({"seq": F.col("pos"), "category": strip("category")})), F.col("pos"), 0.5)
    early = attempts.join(clues.select("episode", "pos", "start_ms"), ["episode", "pos"]).filter("buzz_ms < start_ms")
    emit("V27", early.groupBy("episode").agg(F.count_distinct("pos").alias("n")), F.col("n"))
    cats = board.groupBy("episode", "round").agg(F.count_distinct(strip("category")).alias("cats"), F.count("*").alias("n"))
    emit_each(cats, [("V28", F.col("cats") > 6, F.col("round")), ("V29", (F.col("cats") < 5) & (F.col("n") > 15), F.col("round"))])
    emit("V30", finals.join(has_names, "episode", "left_semi").groupBy("episode").agg(F.count("*").alias("n")).filter("n = 1"))
    return reduce(DataFrame.unionByName, out)


def quality(episodes: DataFrame, clues: DataFrame, found: DataFrame) -> DataFrame:
    """episode, n_clues, weight, label (PASS, DEGRADED, FAIL) and accepted: the gate takes 45 clues or more and a weight of 3 at most."""
    n = clues.groupBy("episode").agg(F.count("*").alias("n_clues"))
    w = found.groupBy("episode").agg(F.sum("weight").alias("weight"), F.count("*").alias("n_warnings"))
    x = episodes.select("episode").join(n, "episode", "left").join(w, "episode", "left").fillna(0)
    bad = F.col("n_clues") < LEAST_CLUES
    label = F.when(bad | (F.col("n_warnings") > 3), "FAIL").when(F.col("n_warnings") > 0, "DEGRADED").otherwise("PASS")
    return x.select("episode", "n_clues", "weight", label.alias("label"), (~bad & (F.col("weight") <= MOST_WEIGHT)).alias("accepted"))
