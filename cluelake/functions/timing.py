"""Buzzer and acoustic measures, and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fillers that count as disfluencies.
FILLERS = ("um", "uh", "er", "ah", "hmm")


def milliseconds(seconds: Column) -> Column:
    return F.coalesce(seconds, F.lit(0.0)) * 1000


def response_start(buzz_ms: Column, lockout: Column) -> Column:
    return buzz_ms + 250 + F.when(lockout, 250).otherwise(0)


def buzz_start(segment_start: Column, found: Column, host_finish_ms: Column) -> Column:
    """Milliseconds of a buzz: the start of its segment (0 where that is null), or the end of the clue without a line number."""
    return F.when(found, F.coalesce(segment_start, F.lit(0.0))).otherwise(host_finish_ms)


def brain_freeze(response_ms: Column, buzz_ms: Column, lockout: Column) -> Column:
    return response_ms - response_start(buzz_ms, lockout)


def buzzer_latency(buzz: Column, light: Column) -> Column:
    """Seconds, to the millisecond."""
    return F.bround(buzz - light, 3)


def acoustics(buzzes: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """confidence (mean probability) and disfluencies of the words (word, start, end, prob) that lie in [t0, t1] of each row of buzzes; 0 without words."""
    j = buzzes.join(words, keys, "left").withColumn("in", (F.col("start") >= F.col("t0")) & (F.col("end") <= F.col("t1")))
    filler = F.regexp_replace(F.lower("word"), r"^[,.?!]+|[,.?!]+$", "").isin(*FILLERS)
    return j.groupBy(*keys, "t0", "t1").agg(
        F.coalesce(F.bround(F.avg(F.when(F.col("in"), F.col("prob"))), 4), F.lit(0.0)).alias("confidence"), F.count_if(F.col("in") & filler).alias("disfluencies")
    )


def token_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """usage (model, input_tokens, output_tokens, thinking_tokens) with cost_usd by prices (model, price_in, price_out for a million tokens); 0 for a model without a price. prices is a dimension of a few rows."""
    x = usage.join(F.broadcast(prices), "model", "left")
    cost = (F.col("input_tokens") * F.col("price_in") + (F.col("output_tokens") + F.col("thinking_tokens")) * F.col("price_out")) / 1e6
    return x.withColumn("cost_usd", F.coalesce(cost, F.lit(0.0))).drop("price_in", "price_out")
