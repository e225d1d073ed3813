"""Board formats, rows from values, category manifests and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.functions.text import dollar_value

# Fixed values: (first round, second round) of each board format.
FORMATS = {"standard": ((200, 400, 600, 800, 1000), (400, 800, 1200, 1600, 2000)), "celebrity": ((100, 200, 300, 400, 500), (200, 400, 600, 800, 1000)), "classic": ((100, 200, 300, 400, 500), (200, 400, 600, 800, 1000))}
TOLERANCE = 100


def board_format(transcript: Column) -> Column:
    """classic if the first two fifths name $100 and not $200, else standard."""
    head = F.substring(transcript, F.lit(1), F.floor(F.length(transcript) * 2 / 5).cast("int"))
    return F.when(head.rlike(r"\$100\b") & ~head.rlike(r"\$200\b"), "classic").otherwise("standard")


def row_of(value: Column, round_: Column, fallback: Column, fmt: str = "standard") -> Column:
    """Board row of a value: its place in the round's grid, else the nearest within 100, else the fallback in 1..5 (null: 3). 1 outside the board."""
    grids = [F.array(*map(F.lit, g)) for g in FORMATS[fmt]]
    grid = F.when(round_ == "J!", grids[0]).otherwise(grids[1])
    near = F.array_sort(F.transform(grid, lambda g, i: F.struct(F.abs(g - value).alias("d"), (i + 1).alias("row"))))[0]
    safe = F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce(fallback, F.lit(3))))
    return F.when(~round_.isin("J!", "Double J!"), 1).when(value.isNull(), safe).when(near["d"] <= TOLERANCE, near["row"]).otherwise(safe)


def announced_row(announcement: Column, round_: Column, fallback: Column, fmt: str = "standard") -> Column:
    """Board row of the value that a selection names."""
    return row_of(dollar_value(announcement), round_, fallback, fmt)


def missing_rows(clues: DataFrame, manifest: DataFrame) -> DataFrame:
    """manifest (episode, round, category) with the sorted rows of 1..5 that no clue has, where there are any."""
    found = clues.groupBy("episode", "round", "category").agg(F.collect_set("board_row").alias("rows"))
    x = manifest.join(found, ["episode", "round", "category"], "left")
    x = x.withColumn("missing", F.array_except(F.sequence(F.lit(1), F.lit(5)), F.coalesce("rows", F.array().cast("array<int>"))))
    return x.filter(F.size("missing") > 0).drop("rows")


def merged_categories(known: Column, discovered: Column) -> Column:
    """Known categories if there are six; else discovered ones if they are more."""
    return F.when((F.size(known) < 6) & (F.size(discovered) > F.size(known)), discovered).otherwise(known)
