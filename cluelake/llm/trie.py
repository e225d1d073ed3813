"""Operator 11: the prefix trie of conversations, built level by level.

A node is known by its depth and the smallest conv_id among the conversations
that begin with its turns. At each depth, the conversations that still share
their node with another are grouped by (parent node, next turn); the group's
smallest conv_id names the child. One that is alone at a node leaves the loop:
the rest of its turns is a chain that needs no grouping, and is told from its
length. So rounds grow with the longest prefix that two conversations share,
not with the longest conversation.

Turns are known by 128 bits of the SHA-256 of role and text, BLOCK of them in a
row; texts are read once and never shuffled. Groups are pre-aggregated and
joined back, so a first turn that a third of all conversations share is a
skewed join, which adaptive execution splits, and not a window in one task.
Then, from the deepest level up, children are summed by parent and joined to
their parents: leaves and savings.

Every level is a table in the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common

#: Turns in a row of the table of turns.
BLOCK = 16
#: Conversation ids in a piece of the text that is hashed for a node.
IDS = 4096
#: First characters of role and text by which turns with equal numbers are ordered.
TIE = 32
#: Rows of a part of the sorted table of turns.
ROWS = 500_000
EMPTY = hashlib.sha256(b"").hexdigest()


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key, words of every turn, by turn (null first), then the first characters of role and text, then their hash.

    A conversation's turns are numbered by ranges of the sorted rows, so one of any length does.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    x = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.substring(role, 1, TIE).alias("r"), F.substring(text, 1, TIE).alias("t"), key.alias("key"), n_words(text).alias("words"))
    x = common.written(x, "trie-rows")
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("r"), F.col("t"), F.col("key")]
    x = common.numbered(x, by, common.parts(x.count(), ROWS), "trie-sorted").drop("turn", "r", "t")
    at = common.pieces(x, "conv_id").select("conv_id", "part", "first", "before")
    return x.join(at, ["conv_id", "part"]).select("conv_id", (F.col("idx") - F.col("first") + F.col("before") + 1).alias("pos"), "key", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(convs: conv_id, len; turns: conv_id, depth, key, words): the first h turns of the group's first conversation, then the own turns after the first h; h is the crc32 of conv_id modulo most.

    Without the group's first conversation, or with fewer turns than h, what is there is taken.
    """
    turn = F.struct("key", "words")
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < most)).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", turn.alias("turn")))).alias("x"))
    first = first.select(F.col("conv_id").alias("base"), F.transform("x", lambda t: t["turn"]).alias("x"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(first, "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.slice("x", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<key:binary,words:bigint>>")))
    convs = convs.withColumn("m", F.size("head").cast("long")).withColumn("len", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = common.written(convs.select("conv_id", "h", "m", "len", "head"), "trie-convs")
    heads = convs.select("conv_id", F.posexplode("head").alias("depth", "t")).select("conv_id", (F.col("depth") + 1).cast("long").alias("depth"), "t.key", "t.words")
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), "key", "words")
    return convs.select("conv_id", "len"), heads.unionByName(own)


def _blocks(turns: DataFrame) -> DataFrame:
    """conv_id, block, turns (key, words): BLOCK successive turns of a conversation in a row."""
    x = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("depth", "key", "words"))).alias("t"))
    return x.select("conv_id", "block", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def _sums(n: Column, depth: Column, longest: Column, children: Column, leaves: Column) -> tuple[Column, Column]:
    """(n_children, n_leaves): who is alone at a node has a chain below it."""
    alone = n == 1
    more = F.when(alone, (longest > depth).cast("long")).otherwise(F.coalesce(children, F.lit(0)))
    return more, F.when(alone, F.lit(1)).otherwise(F.coalesce(leaves, F.lit(1))).cast("long")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    convs: conv_id (unique), len; turns: conv_id, depth (1 .. len), key, words. A
    conversation without turns belongs to the root only, where it ends. Without
    conversations there is no node.
    """
    blocks = common.written(_blocks(turns), "trie-blocks")
    root = common.written(convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("len").alias("longest")).filter("n > 0"), "trie-root")
    top = root.first()
    if top is None:
        schema = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return convs.sparkSession.createDataFrame([], schema)
    levels = [root.select("conv_id", F.lit(None).cast("long").alias("parent"), "n", F.lit(0).cast("long").alias("words"), "longest")]
    ended = [convs.filter("len = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(top.conv_id).cast("long").alias("node"), "conv_id")] if top.n > 1 else []
    alone = [convs.select("conv_id", F.lit(0).cast("long").alias("since"), "len")] if top.n == 1 else []
    live, depth = convs.filter("len > 0").select("conv_id", "len", F.lit(top.conv_id).cast("long").alias("node")), 0
    more = top.n > 1 and top.longest > 0
    while more:
        if depth % BLOCK == 0:
            live = common.written(live.join(blocks.filter(F.col("block") == depth // BLOCK).select("conv_id", "turns"), "conv_id"), "trie-live")
        depth += 1
        first = F.col("turns")[0]
        x = live.withColumn("key", first["key"])
        found = x.groupBy("node", "key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.min(first["words"]).alias("words"), F.max("len").alias("longest"))
        found = common.written(found, "trie-level")
        levels.append(found.select("conv_id", F.col("node").alias("parent"), "n", "words", "longest"))
        shared = found.filter("n > 1").select("node", "key", F.col("conv_id").alias("child"))
        rest = F.slice("turns", F.lit(2), F.lit(BLOCK))
        x = common.written(x.join(shared, ["node", "key"], "left").select("conv_id", "len", F.col("child").alias("node"), F.when(F.col("child").isNotNull() & (F.col("len") > depth), rest).alias("turns")), "trie-live")
        ended.append(x.filter(F.col("node").isNotNull() & (F.col("len") == depth)).select(F.lit(depth).cast("long").alias("depth"), "node", "conv_id"))
        alone.append(x.filter("node IS NULL").select("conv_id", F.lit(depth).cast("long").alias("since"), "len"))
        live = x.filter(F.col("node").isNotNull() & (F.col("len") > depth))
        if depth % BLOCK == 0:
            live = live.drop("turns")
        more = not found.filter((F.col("n") > 1) & (F.col("longest") > depth)).isEmpty()
    nodes = _rolled(levels)
    ends = _hashed(ended, convs.sparkSession)
    first = nodes.join(ends, ["depth", "conv_id"], "left")
    own = F.sha2(F.col("conv_id").cast("string"), 256)
    text = F.when((F.col("n_convs") == 1) & (F.col("longest") == F.col("depth")), own).otherwise(F.coalesce("ends", F.lit(EMPTY)))
    first = first.withColumn("ends_sha256", text).drop("ends", "longest")
    return first.unionByName(_chains(alone, blocks))


def _rolled(levels: list[DataFrame]) -> DataFrame:
    """Sums of each level from the one below it."""
    out, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        x = levels[depth].withColumn("depth", F.lit(depth).cast("long"))
        if below is None:
            x = x.withColumns({c: F.lit(None).cast("long") for c in ("children", "leaves", "saved")})
        else:
            sums = below.groupBy("parent_conv_id").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            x = x.join(sums.withColumnRenamed("parent_conv_id", "conv_id"), "conv_id", "left")
        children, leaves = _sums(F.col("n"), F.col("depth"), F.col("longest"), F.col("children"), F.col("leaves"))
        saved = (F.col("n") - 1) * F.col("words") + F.coalesce("saved", F.lit(0))
        x = x.select("depth", "conv_id", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), children.alias("n_children"), leaves.alias("n_leaves"), saved.alias("saved_tokens"), "longest")
        below = common.written(x, "trie-rolled")
        out.append(below)
    every = out[0]
    for x in out[1:]:
        every = every.union(x)
    return every


def _chains(alone: list[DataFrame], blocks: DataFrame) -> DataFrame:
    """The nodes below one that has one conversation, told block by block."""
    x = alone[0]
    for y in alone[1:]:
        x = x.union(y)
    x = x.filter("len > since")
    lo, hi = F.col("block") * BLOCK, F.col("block") * BLOCK + BLOCK
    x = blocks.select("conv_id", "block").join(x, "conv_id").filter(hi > F.col("since"))
    x = x.select("conv_id", "len", F.explode(F.sequence(F.greatest(lo, F.col("since")) + 1, F.least(hi, F.col("len")))).alias("depth"))
    one, zero, last = F.lit(1).cast("long"), F.lit(0).cast("long"), F.col("depth") == F.col("len")
    return x.select(
        "depth", "conv_id", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )


def _hashed(ended: list[DataFrame], spark) -> DataFrame:
    """depth, conv_id, ends: the hash of the ids that end at each node that several conversations share.

    A hash takes its ids in order, so a node's are read in one task: as texts of
    up to IDS ids, made before they are shuffled, and one such text at a time.
    """
    if not ended:
        return spark.createDataFrame([], "depth long, conv_id long, ends string")
    x = ended[0]
    for y in ended[1:]:
        x = x.union(y)
    x = x.groupBy("depth", "node", F.floor(F.col("conv_id") / IDS).alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    x = x.repartition("depth", "node").sortWithinPartitions("depth", "node", "piece")

    def run(batches):
        now, h = None, None
        for batch in batches:
            out = []
            for d, n, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids"))):
                if (d, n) == now:
                    h.update(b",")
                else:
                    if now is not None:
                        out.append((*now, h.hexdigest()))
                    now, h = (d, n), hashlib.sha256()
                h.update(ids.encode())
            yield _batch(out)
        if now is not None:
            yield _batch([(*now, h.hexdigest())])

    return x.mapInArrow(run, "depth long, conv_id long, ends string")


def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["depth", "conv_id", "ends"])


def prefixes(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations (conv_id, turn, role, text), rebuilt in groups of 20.

    Rows without a conv_id belong to no conversation and are left out; a null
    role or text is empty; a null turn is the first; repeated rows are turns of
    their own; turns with equal numbers stand by their first 32 characters of
    role, then of text, then by their hash. Long texts are only hashed and
    counted where they are read. An empty table has no node. Other columns of
    any name are not looked at.
    """
    common.session(conversations.sparkSession)
    convs, turns = rebuilt(common.written(ordered(conversations), "trie-turns"))
    return trie(convs, turns)


SQL = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {common.crc32_sql('conv_id')} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM t) x),
head AS (SELECT c.conv_id, pos AS depth, role, text FROM c JOIN t ON t.conv_id = base AND pos <= h),
m AS (SELECT c.conv_id, h, count(depth) AS m FROM c LEFT JOIN head USING (conv_id) GROUP BY ALL),
r AS (SELECT * FROM head UNION ALL SELECT conv_id, m + pos - h, role, text FROM t JOIN m USING (conv_id) WHERE pos > h),
p AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, list(sha256(strlen(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, [] FROM c),
q AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
n AS (SELECT depth, node, count(*) AS n, any_value(words) AS words, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS e FROM q GROUP BY depth, node),
up AS (SELECT n.*, q.node AS parent FROM n LEFT JOIN q ON q.conv_id = n.node AND q.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS k FROM up WHERE depth > 0 GROUP BY ALL),
every AS (SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN kids USING (depth, node)),
below AS (SELECT q.depth, q.node, count(*) FILTER (k = 0) AS leaves, sum((n - 1) * every.words) AS saved FROM every JOIN q ON q.conv_id = every.node AND q.depth <= every.depth GROUP BY ALL)
SELECT depth, node AS conv_id, parent AS parent_conv_id, n AS n_convs, k AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, e AS ends_sha256 FROM every JOIN below USING (depth, node)
"""
