"""Operators on transcript segments (episode, pos, speaker, text, start_ms, end_ms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cluelake.functions import text as T

# Markers of the rounds.
DOUBLE, FINAL = ("double j!", "double jeopardy"), ("final j!", "final jeopardy")
#: A run of word characters, as the name pattern's word boundaries see them.
WORD = r"[\p{L}\p{N}_]+"


def has(c: Column, markers: tuple[str, ...]) -> Column:
    out = F.lower(c).contains(markers[0])
    for m in markers[1:]:
        out = out | F.lower(c).contains(m)
    return out


def compressed(segments: DataFrame) -> DataFrame:
    """One transcript text for each episode: a line for each segment."""
    line = T.transcript_line(F.col("pos"), F.col("speaker"), F.col("text"))
    x = segments.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("x"))
    return x.select("episode", F.array_join(F.transform("x", lambda s: s["line"]), "\n").alias("transcript"))


def in_range(anchors: DataFrame, segments: DataFrame, before: int, after: int) -> DataFrame:
    """Segments within [at - before, at + after] of each anchor (episode, at): a band join within the episode."""
    s = segments.select("episode", "pos", "speaker", "text", "start_ms", "end_ms")
    return anchors.join(s, (anchors["episode"] == s["episode"]) & s["pos"].between(F.col("at") - before, F.col("at") + after)).drop(s["episode"])


def at_line(clues: DataFrame, segments: DataFrame, line: str, prefix: str) -> DataFrame:
    """clues with start and end of the segment that a line number names; the equi join on position."""
    s = segments.select("episode", F.col("pos").alias(line), F.col("start_ms").alias(f"{prefix}_start"), F.col("end_ms").alias(f"{prefix}_end"))
    return clues.join(s, ["episode", line], "left")


def gaps(segments: DataFrame, over_ms: float = 3000) -> DataFrame:
    """Silences before segments."""
    w = Window.partitionBy("episode").orderBy("pos")
    x = segments.withColumn("gap_ms", F.coalesce("start_ms", F.lit(0)) - F.coalesce(F.lag("end_ms").over(w), F.coalesce("start_ms", F.lit(0))))
    return x.filter(F.col("gap_ms") > over_ms)


def backwards(segments: DataFrame, slack_ms: float = 500) -> DataFrame:
    """Segments that start over half a second before the one before them."""
    w = Window.partitionBy("episode").orderBy("pos")
    return segments.withColumn("before", F.lag("start_ms").over(w)).filter(F.col("start_ms") < F.col("before") - slack_ms)


def round_regions(segments: DataFrame, overlap: int = 20) -> DataFrame:
    """episode, pos, region (J, DJ, FJ): a segment near a boundary is in two. Without a boundary all are in J."""
    dj = segments.filter((F.col("pos") > 10) & has(F.col("text"), DOUBLE)).groupBy("episode").agg(F.min("pos").alias("dj"))
    fj = segments.join(dj, "episode").filter((F.col("pos") > F.col("dj") + 10) & has(F.col("text"), FINAL)).groupBy("episode").agg(F.min("pos").alias("fj"))
    x = segments.join(dj, "episode", "left").join(fj, "episode", "left")
    p, d, f = F.col("pos"), F.col("dj"), F.col("fj")
    j = F.when(d.isNull() | (p < d + overlap), "J")
    dd = F.when(d.isNotNull() & (p >= d - overlap) & (f.isNull() | (p < f + overlap)), "DJ")
    return x.select("episode", "pos", F.explode(F.array_compact(F.array(j, dd, F.when(p >= f, "FJ")))).alias("region"))


def chunks(segments: DataFrame, most: int = 2000, overlap: int = 40, least: int = 10) -> DataFrame:
    """episode, chunk, first, last (positions): cut after a marker line when a chunk has over 10 lines; longer chunks are cut with an overlap.

    Where a chunk is closed depends on where the last one was: a fold over the marker positions, not over all lines.
    """
    marks = segments.filter(has(F.col("text"), DOUBLE + FINAL)).groupBy("episode").agg(F.sort_array(F.collect_list("pos")).alias("marks"))
    n = segments.groupBy("episode").agg(F.max("pos").alias("top"))
    x = n.join(marks, "episode", "left").withColumn("marks", F.coalesce("marks", F.array().cast("array<bigint>")))
    cut = F.aggregate("marks", F.array(F.lit(-1).cast("long")), lambda a, p: F.when(p - F.element_at(a, -1) > least, F.array_append(a, p)).otherwise(a))
    x = x.select("episode", "top", cut.alias("cut"))
    ends = F.when(F.element_at("cut", -1) < F.col("top"), F.array_append("cut", F.col("top"))).otherwise(F.col("cut"))
    x = x.select("episode", ends.alias("e"))
    x = x.select("episode", F.explode(F.transform(F.sequence(F.lit(1), F.size("e") - 1), lambda i: F.struct((F.get("e", i - 1) + 1).alias("a"), F.get("e", i).alias("b")))).alias("c"))
    x = x.select("episode", F.col("c.a").alias("a"), F.col("c.b").alias("b"))
    long = F.col("b") - F.col("a") + 1 > most
    x = x.select("episode", "a", "b", F.explode(F.when(long, F.sequence(F.col("a"), F.col("b"), F.lit(most - overlap).cast("long"))).otherwise(F.array("a"))).alias("first"))
    x = x.select("episode", "first", F.when(F.col("b") - F.col("a") + 1 > most, F.least(F.col("first") + most - 1, F.col("b"))).otherwise(F.col("b")).alias("last"))
    return x.withColumn("chunk", F.row_number().over(Window.partitionBy("episode").orderBy("first")).cast("long"))


def batches(rows: DataFrame, key: str, order: str, size: int = 12) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return rows.withColumns({"batch": F.floor(n / size), "slot": n % size})


def tail(segments: DataFrame, n: int = 40) -> DataFrame:
    """The last n segments of each episode."""
    return segments.withColumn("left", F.max("pos").over(Window.partitionBy("episode")) - F.col("pos")).filter(F.col("left") < n).drop("left")


def name_mentions(segments: DataFrame, stop: tuple[str, ...] = T.NO_NAMES, top: int = 3) -> DataFrame:
    """episode, name, n, rank: capitalised words that the host says most (the host has most segments), without stop words."""
    turns = segments.groupBy("episode", "speaker").agg(F.count("*").alias("k"), F.min("pos").alias("p"))
    host = turns.groupBy("episode").agg(F.max_by("speaker", F.struct("k", -F.col("p"))).alias("speaker"))
    names = F.filter(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda w: w.rlike("^[A-Z][a-z]{2,}$"))
    said = segments.join(host, ["episode", "speaker"]).select("episode", "pos", F.posexplode(names).alias("i", "name"))
    said = said.filter(~F.col("name").isin(*stop))
    n = said.groupBy("episode", "name").agg(F.count("*").alias("n"), F.min(F.struct("pos", "i")).alias("f"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("episode").orderBy(F.desc("n"), "f"))).filter(F.col("rank") <= top).drop("f")


def speaker_ids(segments: DataFrame) -> DataFrame:
    """episode, short, speaker: what an abbreviated speaker stands for; the last one where two are shortened alike."""
    x = segments.withColumn("short", T.abbreviated(F.col("speaker"))).filter("short <> speaker")
    return x.groupBy("episode", "short").agg(F.max_by("speaker", "pos").alias("speaker"))


def monotonic(segments: DataFrame, slack_ms: float = 500, most: float = 0.02) -> DataFrame:
    """episode, n, n_back, ok: whether under 2 % of the segments start before the one before them."""
    back = backwards(segments, slack_ms).groupBy("episode").agg(F.count("*").alias("n_back"))
    x = segments.groupBy("episode").agg(F.count("*").alias("n")).join(back, "episode", "left").fillna(0, ["n_back"])
    return x.withColumn("ok", F.col("n_back") < F.col("n") * most)


def _joined(window: DataFrame, keys: list[str], line: Column, by: str) -> DataFrame:
    x = window.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("x"))  # a window's few segments
    return x.select(*keys, F.array_join(F.transform("x", lambda s: s["line"]), by).alias("joined"))


def clue_context(clues: DataFrame, segments: DataFrame, before: int = 3, after: int = 8) -> DataFrame:
    """clues (episode, first, last: positions) with context: the lines around, with marks where the clue starts and ends."""
    mark = F.concat(F.when(F.col("pos") == F.col("first"), " ◄ CLUE START").otherwise(""), F.when(F.col("pos") == F.col("last"), " ◄ CLUE END").otherwise(""))
    line = F.concat(F.lit("L"), F.col("pos").cast("string"), F.lit(" ["), F.coalesce("speaker", F.lit("?")), F.lit("]: "), T.stripped(F.coalesce("text", F.lit(""))), mark)
    s = segments.select("episode", "pos", "speaker", "text")
    x = clues.select("episode", "first", "last").distinct().join(s, "episode").filter(F.col("pos").between(F.col("first") - before, F.col("last") + after))
    return _joined(x, ["episode", "first", "last"], line, "\n").withColumnRenamed("joined", "context")


def spliced(clues: DataFrame, segments: DataFrame, least: int = 10) -> DataFrame:
    """clues (episode, key, first, last, said, category) with text: what was said, if it has ten characters or more, else the segments' text without its preamble. A last before the first is taken as the first."""
    s = segments.select("episode", "pos", "text")
    x = clues.select("episode", "key", "first", F.greatest("first", "last").alias("last")).join(s, "episode").filter(F.col("pos").between(F.col("first"), F.col("last")))
    x = _joined(x, ["episode", "key"], T.stripped(F.col("text")), " ")
    own = T.stripped(F.coalesce("said", F.lit("")))
    heard = T.without_preamble(T.stripped(F.coalesce("joined", F.lit(""))), F.col("category"))
    return clues.join(x, ["episode", "key"], "left").withColumn("text", F.when(F.length(own) >= least, own).otherwise(heard)).drop("joined")


def without_final(clues: DataFrame) -> DataFrame:
    """Clues that are extracted from the transcript's boards: the Final's has a place of its own."""
    return clues.filter(~F.col("round").eqNullSafe(F.lit("Final J!")))


def selection_context(clues: DataFrame, segments: DataFrame, before: int = 2) -> DataFrame:
    """clues (episode, key, first) with announced: the text of up to two segments before and of the first one; null at the transcript's start."""
    s = segments.select("episode", "pos", "text")
    x = clues.filter("first > 0").select("episode", "key", "first").join(s, "episode").filter(F.col("pos").between(F.col("first") - before, F.col("first")))
    return clues.join(_joined(x, ["episode", "key"], F.col("text"), " ").withColumnRenamed("joined", "announced"), ["episode", "key"], "left")
