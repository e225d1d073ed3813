"""Operator 7: quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured by rules; failures are added up by host; a host's
failure rate is shrunk by a beta prior fitted to all hosts by the method of
moments; documents of hosts whose shrunk rate is over a limit are rejected
with those that fail the base rules. A null text has no words and fails; a
null host is a host of its own; repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common

GAP = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
#: A host is rejected if its shrunk failure rate is over this.
HOST_LIMIT = 0.75
#: Strength of the prior, in documents, at least and at most.
STRENGTH = (1.0, 1000.0)
#: Rejected hosts are broadcast if there are this many at most (rows of under 300 bytes).
BROADCAST_ROWS = 50_000


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns q_n_words, q_word_chars, q_n_symbols, q_n_lines, q_n_dup_lines, q_n_repeat_words (long)."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({"q_words": F.array_remove(F.split(t, GAP), ""), "q_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    n = F.size("q_words")
    out = out.withColumns({"q_mask": F.pow(F.lit(2.0), F.length(F.bin(n))).cast("long") - 1})
    word = lambda i: F.get("q_words", i.cast("int"))
    # a window's hash, its low bits replaced by where it starts: sorting brings equal windows together
    key = lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)).bitwiseAND(F.bitwise_not(F.col("q_mask"))).bitwiseOR(i.cast("long"))
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("q_keys", F.sort_array(F.transform(starts, key)))
    same = lambda a, b: (a.bitwiseXOR(b) <= F.col("q_mask")) & (a.bitwiseXOR(b) >= 0) & _equal(a, b, word)
    m = F.size("q_keys")
    near = lambda i: ((i > 0) & same(F.get("q_keys", i), F.get("q_keys", i - 1))) | ((i < m - 1) & same(F.get("q_keys", i), F.get("q_keys", i + 1)))
    order = F.when(m > 0, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>"))
    found = F.sort_array(F.transform(F.filter(order, near), lambda i: F.get("q_keys", i).bitwiseAND(F.col("q_mask"))))
    zero = F.struct(F.lit(-3).cast("long").alias("at"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(found, zero, lambda a, s: F.struct(s.alias("at"), (a["n"] + F.least(F.lit(3).cast("long"), s - a["at"])).alias("n")), lambda a: a["n"])
    out = out.withColumns(
        {
            "q_n_words": n.cast("long"),
            "q_word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "q_n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
            "q_n_lines": F.size("q_lines").cast("long"),
            "q_n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "q_n_repeat_words": covered,
        }
    )
    return out.drop("q_words", "q_lines", "q_keys", "q_mask")


def _equal(a: Column, b: Column, word) -> Column:
    i, j = a.bitwiseAND(F.col("q_mask")), b.bitwiseAND(F.col("q_mask"))
    return (word(i) == word(j)) & (word(i + 1) == word(j + 1)) & (word(i + 2) == word(j + 2))


def base_failed() -> Column:
    return (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words"))


def rule_failed() -> Column:
    """The base rules; over a tenth of the characters are symbols; over half of the lines repeat; words of under 2 or over 20 characters on average."""
    n = F.col("q_n_words")
    return base_failed() | (10 * F.col("q_n_symbols") > F.col("q_word_chars")) | (2 * F.col("q_n_dup_lines") > F.col("q_n_lines")) | (F.col("q_word_chars") < 2 * n) | (F.col("q_word_chars") > 20 * n)


def hosts(rows: DataFrame, host: str = "source", failed: Column | None = None) -> DataFrame:
    """host, n, failed, rate (shrunk), host_ok of each host of measured rows."""
    by = rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.count_if(rule_failed() if failed is None else failed).alias("failed"))
    rate = F.col("failed") / F.col("n")
    prior = by.agg(F.avg(rate).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v"))
    strength = F.when(F.col("v") > 0, F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(F.lit(STRENGTH[1]))
    prior = prior.select(F.lit(1).alias("one"), (F.col("m") * strength).alias("alpha"), strength.alias("both"))  # a single row
    out = by.withColumn("one", F.lit(1)).join(F.broadcast(prior), "one")
    out = out.withColumn("rate", (F.col("failed") + F.col("alpha")) / (F.col("n") + F.col("both")))
    return out.select("host", "n", "failed", "rate", (F.col("rate") <= HOST_LIMIT).alias("host_ok"))


def _few(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its counted rows are few enough; beyond, Spark splits the partitions of large hosts in the shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of each row of docs (doc_id, text, source).

    A null or empty text has no words and fails the base rules. A null host is
    a host of its own. Repeated rows count, and are judged, as often as they
    occur. An empty table gives an empty one; other columns of docs are left out.
    """
    common.session(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    rows = common.written(measured(docs.select("doc_id", "text", "source")).drop("text"), "quality")
    bad = common.written(hosts(rows).filter("NOT host_ok").select("host", F.lit(True).alias("bad")), "bad-hosts")
    out = rows.join(_few(bad), rows["source"].eqNullSafe(F.col("host")), "left")
    return out.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in names if c != "n_lines"], base_failed().alias("base_failed"), (~base_failed() & F.col("bad").isNull()).alias("kept"))


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with their own columns, whatever these are called.

    Null texts, null hosts, repeated rows and an empty table fare as in verdicts.
    """
    common.session(docs.sparkSession)
    cols = docs.columns
    rows = docs.select(*[docs[f"`{c}`"].alias(f"d{i}") for i, c in enumerate(cols)])
    host, text = f"d{cols.index('source')}", f"d{cols.index('text')}"
    rows = measured(rows, text).withColumns({"q_failed": base_failed(), "q_rules": rule_failed()})
    # of a document that fails by itself only the host is wanted
    rows = rows.select(*[F.when(~F.col("q_failed"), F.col(c)).alias(c) if c == text else c for c in rows.columns if c.startswith("d")], "q_failed", "q_rules")
    rows = common.written(rows, "quality")
    bad = common.written(hosts(rows, host, F.col("q_rules")).filter("NOT host_ok").select("host"), "bad-hosts")
    out = rows.filter("NOT q_failed").join(_few(bad), F.col(host).eqNullSafe(F.col("host")), "left_anti")
    return out.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(cols)])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS (SELECT rid, doc_id, source, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
pos AS (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM m WHERE len(words) >= 3),
win AS (SELECT rid, i, [words[i], words[i + 1], words[i + 2]] AS w FROM pos),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS k FROM win) x WHERE k > 1),
cov AS (SELECT rid, count(DISTINCT j) AS k FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM rep) x GROUP BY rid),
f AS (SELECT doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(k, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM f),
r AS (SELECT *, (base_failed OR 10 * n_symbols > word_chars OR 2 * n_dup_lines > n_lines
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS k FROM r GROUP BY source),
p AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, least(1000.0, m * (1 - m) / v - 1)) ELSE 1000.0 END AS z FROM p),
ok AS (SELECT source, (k + m * z) / (n + z) <= 0.75 AS host_ok FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND host_ok) AS kept
FROM r JOIN ok ON r.source IS NOT DISTINCT FROM ok.source
"""
