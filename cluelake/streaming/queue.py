"""The durable work queue: status graph, claims, retries, resets, as table operations and as a stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The status graph.
NEXT = {
    "PENDING": "TRANSCRIBING", "TRANSCRIBING": "TRANSCRIPT_READY", "TRANSCRIPT_READY": "CLEANED", "CLEANED": "SAVING", "SAVING": "MULTIMODAL_PROCESSING",
    "MULTIMODAL_PROCESSING": "MULTIMODAL_DONE", "MULTIMODAL_DONE": "VECTORIZING", "VECTORIZING": "COMPLETED",
}
# In-flight statuses and where a crash puts them back.
RESET = {"TRANSCRIBING": "PENDING", "CLEANED": "TRANSCRIPT_READY", "MULTIMODAL_PROCESSING": "SAVING", "VECTORIZING": "MULTIMODAL_DONE"}
# Statuses in which a stage is complete.
COMPLETE = {
    "transcribe": ("TRANSCRIPT_READY", "CLEANED", "SAVING", "MULTIMODAL_PROCESSING", "MULTIMODAL_DONE", "VECTORIZING", "COMPLETED"),
    "extract": ("SAVING", "MULTIMODAL_PROCESSING", "MULTIMODAL_DONE", "VECTORIZING", "COMPLETED"),
    "augment": ("MULTIMODAL_DONE", "VECTORIZING", "COMPLETED"),
    "verify": ("COMPLETED",),
}
# The stages that run for each choice of a stage.
ACTIVE = {
    "all": ("transcribe", "extract", "augment", "verify"), "transcribe": ("transcribe",), "extract": ("extract",), "augment": ("augment",), "verify": ("verify",),
}
MAX_RETRIES, ERROR_CHARS = 3, 500


def claim(queue: DataFrame, source: str, target: str, n: int = 1) -> tuple[DataFrame, DataFrame]:
    """(queue, claimed): the n oldest rows (created_at, then id) of a status move to another. Two claims in turn never take one row."""
    oldest = queue.filter(F.col("status") == source).orderBy("created_at", "id").limit(n)
    taken = oldest.select("id").withColumn("_taken", F.lit(True))
    out = queue.join(F.broadcast(taken), "id", "left").withColumn("status", F.when(F.col("_taken"), target).otherwise(F.col("status"))).drop("_taken")  # n rows
    return out, oldest


def failed(queue: DataFrame, failures: DataFrame) -> DataFrame:
    """failures (id, previous_status, error): FAILED at the third retry, else back to the previous status with one more retry."""
    j = queue.join(failures, "id", "left")
    hit, dead = F.col("previous_status").isNotNull(), F.col("retry_count") >= MAX_RETRIES
    return j.select(
        *[c for c in queue.columns if c not in ("status", "retry_count", "last_error")],
        F.when(hit & dead, "FAILED").when(hit, F.col("previous_status")).otherwise(F.col("status")).alias("status"),
        F.when(hit & ~dead, F.col("retry_count") + 1).otherwise(F.col("retry_count")).alias("retry_count"),
        F.when(hit, F.substring("error", 1, ERROR_CHARS)).otherwise(F.col("last_error")).alias("last_error"),
    )


def _mapped(c, pairs: dict[str, str]):
    out = c
    for k, v in pairs.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def reset_failed(queue: DataFrame, target: str = "PENDING") -> DataFrame:
    dead = F.col("status") == "FAILED"
    return queue.withColumns({"retry_count": F.when(dead, 0).otherwise(F.col("retry_count")), "last_error": F.when(~dead, F.col("last_error")), "status": F.when(dead, target).otherwise(F.col("status"))})


def reset_in_flight(queue: DataFrame) -> DataFrame:
    return queue.withColumn("status", _mapped(F.col("status"), RESET))


def open_for(files: DataFrame, stage: str | None) -> DataFrame:
    """files (status) that a stage hasn't completed; an unknown stage filters nothing."""
    return files.filter(~F.col("status").isin(*COMPLETE[stage])) if stage in COMPLETE else files


def illegal(history: DataFrame) -> DataFrame:
    """Steps of history (id, seq, status) that the graph doesn't have; FAILED is always allowed."""
    w = Window.partitionBy("id").orderBy("seq")
    x = history.withColumn("before", F.lag("status").over(w)).filter("before IS NOT NULL")
    return x.filter((F.col("status") != "FAILED") & ~F.col("status").eqNullSafe(F.when(F.col("before").isin(*NEXT), _mapped(F.col("before"), NEXT))))


def drained(queue: DataFrame, statuses: list[str]) -> DataFrame:
    """depth, drained: rows in the statuses."""
    n = F.count_if(F.col("status").isin(*statuses))
    return queue.agg(n.alias("depth"), (n == 0).alias("drained"))


STATE = "status string, retry_count int, last_error string"


def _fold(key, frames, state):
    status, retries, error = state.get if state.exists else ("PENDING", 0, None)
    for f in frames:
        for r in f.sort_values("seq").itertuples():
            if r.outcome == "ok":
                status = NEXT.get(status, status)
            elif retries >= MAX_RETRIES:
                status, error = "FAILED", str(r.error)[:ERROR_CHARS]
            else:
                retries, error = retries + 1, str(r.error)[:ERROR_CHARS]
                status = RESET.get(status, status)
    state.update((status, retries, error))
    yield pd.DataFrame({"id": [key[0]], "status": [status], "retry_count": [retries], "last_error": [error]})


def stream(outcomes: DataFrame) -> DataFrame:
    """The state of each id after a stream of outcomes (id, seq, outcome: ok or fail, error)."""
    return outcomes.groupBy("id").applyInPandasWithState(_fold, f"id long, {STATE}", STATE, "update", "NoTimeout")


# Where a stage's rows go when it is run anew.
STAGE_INPUT = {"transcribe": "PENDING", "extract": "TRANSCRIPT_READY", "augment": "SAVING", "verify": "MULTIMODAL_DONE"}
# Statuses that must be empty before a stage's worker may end, when all stages run together.
UPSTREAM = {
    "PENDING": ("PENDING",),
    "TRANSCRIPT_READY": ("PENDING", "TRANSCRIBING", "TRANSCRIPT_READY", "CLEANED"),
    "SAVING": ("PENDING", "TRANSCRIBING", "TRANSCRIPT_READY", "CLEANED", "SAVING"),
    "MULTIMODAL_DONE": ("PENDING", "TRANSCRIBING", "TRANSCRIPT_READY", "CLEANED", "SAVING", "MULTIMODAL_PROCESSING", "MULTIMODAL_DONE", "VECTORIZING"),
}
# The same for a stage that runs alone.
ISOLATED = {"PENDING": ("PENDING",), "TRANSCRIPT_READY": ("TRANSCRIPT_READY", "CLEANED"), "SAVING": ("SAVING", "MULTIMODAL_PROCESSING"), "MULTIMODAL_DONE": ("MULTIMODAL_DONE", "VECTORIZING")}


def stage_reset(queue: DataFrame, stage: str) -> DataFrame:
    """FAILED rows go back to the input of a stage, or to the start."""
    return reset_failed(queue, STAGE_INPUT.get(stage, "PENDING"))


def may_end(queue: DataFrame, target: str, alone: bool = False) -> DataFrame:
    return drained(queue, list((ISOLATED if alone else UPSTREAM)[target]))
