"""Operator 5: benchmark decontamination by a positional inverted index, in DataFrame functions only.

The index stores where the terms of the test set occur in the documents: a
posting (doc_id, pos, term) for each occurrence. It is partitioned by
documents, so a frequent term never meets in one task and building it moves
no rows. A window of a test item is found by its terms from the rarest on:
the posting lists of its two rarest terms are adjusted by their offsets and
intersected; what is left is intersected with the lists of the other terms,
which makes a match exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common

#: Separators, with A-Z taken as letters; lower-casing them afterwards gives the same words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: A side of a join is broadcast if it has this many rows at most (rows of under 100 bytes); beyond, both sides are shuffled.
BROADCAST_ROWS = 100_000


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def tokens(text: Column) -> Column:
    """The words of a text, as they are written."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lowered(word: Column) -> Column:
    """A-Z to a-z. lower() does so for ASCII words, and would change other letters too."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, win, k (words of the window), terms: every run of `size` words of an item, or all of a shorter item."""
    w = items.select("item_id", tokens(F.translate("text", UPPER, LOWER)).alias("w")).filter(F.size("w") > 0)
    w = w.select("item_id", "w", F.least(F.size("w"), F.lit(size)).alias("k"))
    w = w.select("item_id", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("s"))
    return w.select("item_id", "k", F.slice("w", F.col("s"), F.col("k")).alias("terms")).distinct().withColumn("win", F.xxhash64("item_id", "terms"))


def search(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """(sizes, hits): row, doc_id, n_words of each row of docs; row, item_id, win, at, k of each match.

    slop 0: exact phrases. With a slop, a window also matches where its two
    rarest terms stand up to `slop` words nearer or farther than in the item
    and each other term occurs within `slop` words of its place (proximity).
    """
    return _search(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), items, size, slop)


def _search(rows: DataFrame, items: DataFrame, size: int, slop: int) -> tuple[DataFrame, DataFrame]:
    common.session(rows.sparkSession)
    wins = common.written(windows(items, size), "windows")
    terms = wins.select(F.explode("terms").alias("term")).distinct()
    code = F.xxhash64("term")
    small = _small(terms.select("term", code.alias("code")))
    w = rows.select("row", "doc_id", tokens(F.col("text")).alias("w"))
    w = w.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode(F.array_append("w", F.lit(""))).alias("pos", "word"))
    # the empty word after the last one carries the size; all others carry nothing but their place
    w = w.withColumn("term", lowered(F.col("word"))).join(small, "term", "left")
    w = w.filter(F.col("code").isNotNull() | (F.col("word") == ""))
    index = common.written(w.select("row", "pos", "code", F.when(F.col("word") == "", F.col("doc_id")).alias("doc_id"), F.when(F.col("word") == "", F.col("n_words")).alias("n_words")), "postings")
    sizes = index.filter(F.col("n_words").isNotNull()).select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    postings = index.filter(F.col("n_words").isNull()).select("row", "pos", "code")
    return sizes, _matches(postings, wins, slop)


def _matches(postings: DataFrame, wins: DataFrame, slop: int) -> DataFrame:
    freq = postings.groupBy("code").agg(F.count("*").alias("freq"))
    each = wins.select("item_id", "win", "k", F.posexplode("terms").alias("off", "term"))
    each = each.withColumn("code", F.xxhash64("term")).join(freq, "code", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    ranked = each.groupBy("item_id", "win", "k").agg(F.sort_array(F.collect_list(F.struct("freq", "off", "code"))).alias("t"))  # k terms at most
    ranked = common.written(ranked.filter(F.col("t")[0]["freq"] > 0), "ranked")
    one, two = F.col("t")[0], F.col("t")[F.least(F.lit(1), F.size("t") - 1)]
    spread = F.sequence(F.lit(-slop), F.lit(slop))
    first = ranked.select("win", "k", one["code"].alias("code"), one["off"].alias("off"), F.lit(1).alias("a"), F.lit(0).alias("d"))
    second = ranked.select("win", "k", two["code"].alias("code"), two["off"].alias("off"), F.lit(2).alias("a"), F.explode(spread).alias("d"))
    anchors = first.union(second)
    lists = postings.join(_small(anchors), "code").select("row", "win", "k", (F.col("pos") - F.col("off") - F.col("d")).alias("at"), "a")
    both = lists.groupBy("row", "win", "k", "at").agg(F.bit_or("a").alias("a")).filter("a = 3").drop("a")
    both = common.written(both, "pairs")
    want = both.join(_small(ranked.select("win", F.posexplode(F.transform("t", lambda x: F.struct(x["off"].alias("off"), x["code"].alias("code")))).alias("no", "x"))), "win")
    want = want.select("row", "win", "k", "at", "no", (F.col("at") + F.col("x.off")).alias("pos"), F.col("x.code").alias("code"))
    if slop:
        want = want.withColumn("pos", F.explode(F.transform(spread, lambda d: F.col("pos") + d)))
    near = postings.join(_small(both.select("row").distinct()), "row", "left_semi")
    full = want.join(near, ["row", "pos", "code"]).groupBy("row", "win", "k", "at").agg(F.count_distinct("no").alias("n") if slop else F.count("*").alias("n"))
    return full.filter(F.col("n") == F.col("k")).join(wins.select("item_id", "win"), "win").select("row", "item_id", "win", "at", "k")


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of docs.

    A null text has no words; null or empty items match nothing; without any
    item every document is clean. Rows with equal ids are judged on their own.
    """
    sizes, hits = search(docs, items, size)
    hits = common.written(hits, "hits")
    found = hits.groupBy("row").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    runs = hits.select("row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("k") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    out = sizes.join(found.join(runs, "row"), "row", "left")
    items_of = F.coalesce(F.sort_array("items"), F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW, stored: bool = False) -> DataFrame:
    """The rows of docs without a match, with their own columns. stored: docs is a table as read from files."""
    cols = docs.columns
    rows = common.numbered_rows(docs, stored)
    _, hits = _search(rows.select("row", F.col("row").alias("doc_id"), F.col(f"d{cols.index('text')}").alias("text")), items, size, 0)
    found = common.written(hits.select("row").distinct(), "contaminated")
    return rows.join(_small(found), "row", "left_anti").select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(cols)])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bp AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM bp),
ks AS (SELECT DISTINCT k FROM win),
dp AS (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k),
hit AS (SELECT dg.rid, win.item_id, dg.s, dg.k FROM (SELECT rid, s, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM dp) dg JOIN win ON win.k = dg.k AND win.g = dg.g),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hit) x GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS x FROM hit) y GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN i USING (rid)
"""
