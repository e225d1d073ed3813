"""Operator 13: a Merkle manifest of a dataset, with a proof of each row.

Rows are leaves; the leaves of each tree (one for each value of a column), in
order, are hashed in runs of ARITY neighbours, level by level, to a root, and
the trees' roots to one root in the same way.

A *fragment* is a sparse forest: nodes that are known, keyed by (tree, level,
index), of which no run of siblings is complete. How many nodes a level has is
known from the count of leaves, and so is the arity of its last run. Merging
two fragments unites their nodes and replaces every run that is complete by its
parent, level by level; that is associative, with the empty fragment as its
unit. A partition folds its stretch of leaves to at most 2 * (ARITY - 1) nodes
a level; fragments of neighbours are merged as treeReduce does it, FRAGMENTS at
a time, but each round is a written table: the runs that a merge completes are
kept there, as proofs need them, and nothing gathers on the driver. A tree that
lies within one partition never leaves it.

Proofs: a partition folds its leaves again and asks for the few runs on the
paths of its two ends that other partitions share.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common

ARITY = 8
#: Leaves of a partition, 100 bytes each when they are shuffled.
LEAVES = 100_000
#: Fragments merged in a task.
FRAGMENTS = 16

Node = tuple[int, int, int]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def runs(n: int) -> int:
    return -(-n // ARITY)


def fold(at: int, nodes: list[str], total: int) -> tuple[list[tuple[int, list[str]]], list[tuple[int, int, str]]]:
    """(levels, open): nodes are the leaves at, at + 1, .. of a tree of total leaves.

    levels: the first index and the nodes of each level that these leaves alone
    decide; open: (level, index, hash) of nodes whose run isn't complete here.
    A whole tree's last level is its root, with nothing open.
    """
    levels, left = [(at, nodes)], []
    while total > 1:
        level, end = len(levels) - 1, at + len(nodes)
        a, b = runs(at), runs(end) if end == total else end // ARITY
        if b <= a:
            return levels, left + [(level, at + i, h) for i, h in enumerate(nodes)]
        left += [(level, at + i, h) for i, h in enumerate(nodes[: a * ARITY - at])]
        left += [(level, b * ARITY + i, h) for i, h in enumerate(nodes[b * ARITY - at :])]
        nodes = [digest("".join(nodes[r * ARITY - at : (r + 1) * ARITY - at])) for r in range(a, b)]
        at, total = a, runs(total)
        levels.append((at, nodes))
    return levels, left


def merge(nodes: dict[Node, str], totals: dict[int, int]) -> tuple[dict[Node, str], dict[Node, list[str]]]:
    """(fragment, runs): nodes of several fragments, reduced; the runs that became complete, by (tree, level, index of the parent below level + 1)."""
    found: dict[Node, list[str]] = {}
    out: dict[Node, str] = {}
    levels: dict[int, dict[tuple[int, int], dict[int, str]]] = defaultdict(lambda: defaultdict(dict))
    for (tree, level, i), h in nodes.items():
        levels[level][tree, i // ARITY][i] = h
    while levels:
        level = min(levels)
        for (tree, r), run in levels.pop(level).items():
            size = totals[tree]
            for _ in range(level):
                size = runs(size)
            if size > 1 and len(run) == min(ARITY, size - r * ARITY):
                found[tree, level, r] = [run[i] for i in sorted(run)]
                levels[level + 1][tree, r // ARITY][r] = digest("".join(found[tree, level, r]))
            else:
                out |= {(tree, level, i): h for i, h in run.items()}
    return out, found


def shared(at: int, levels: list[tuple[int, list[str]]], n: int, total: int) -> set[tuple[int, int]]:
    """(level, run) of all runs over the leaves at .. at + n - 1 that these don't decide alone."""
    out, a, b, level = set(), at, at + n - 1, 0
    while total > 1:
        first, nodes = levels[level + 1] if level + 1 < len(levels) else (0, [])
        out |= {(level, r) for r in (a // ARITY, b // ARITY) if not first <= r < first + len(nodes)}
        a, b, level, total = a // ARITY, b // ARITY, level + 1, runs(total)
    return out


_FOLDED = "kind string, slot long, tree long, total long, level long, at long, hash string, run array<string>"
_COLUMNS = ["kind", "slot", "tree", "total", "level", "at", "hash", "run"]


def _frame(rows: Iterable[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS)


def _stretches(leaves: pd.DataFrame, parts: pd.DataFrame):
    """(tree, before, total, rows) of each tree's leaves in a partition."""
    leaves = leaves.sort_values("idx", ignore_index=True)
    for p in parts.itertuples():
        first = int(p.first)  # a column that is null in other rows is one of floats
        yield int(p.tree), int(p.before), int(p.total), leaves.iloc[first : first + int(p.n)]


def _fold_part(key: tuple, leaves: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
    out = []
    for tree, at, total, rows in _stretches(leaves, parts.sort_values("first")):
        levels, left = fold(at, [h.hex() for h in rows["leaf"]], total)
        if at == 0 and len(rows) == total:
            out.append(("root", key[0], tree, total, 0, 0, levels[-1][1][0], None))
            continue
        out += [("node", key[0], tree, total, level, i, h, None) for level, i, h in left]
        out += [("need", key[0], tree, total, level, r, None, None) for level, r in shared(at, levels, len(rows), total)]
    return _frame(out)


def _merge_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    totals = dict(zip(rows["tree"], rows["total"]))
    left, found = merge({(r.tree, r.level, r.at): r.hash for r in rows.itertuples()}, totals)
    out = [("run", key[0], t, totals[t], level, r, None, run) for (t, level, r), run in found.items()]
    for (t, level, i), h in left.items():
        size = totals[t]
        for _ in range(level):
            size = runs(size)
        out.append(("root" if size == 1 else "node", key[0], t, totals[t], level, i, h, None))
    return _frame(out)


def reduced(leaves: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(roots, needed): tree and hash of each root; part, tree, level, at, run: the runs that a part needs of those that merges have completed.

    leaves: part, idx, leaf (binary); parts: part, tree, first, n, before, total.
    """
    folded = common.written(leaves.groupBy("part").cogroup(parts.groupBy("part")).applyInPandas(_fold_part, _FOLDED), "merkle-fold")
    tables, nodes = [folded], folded.filter("kind = 'node'")
    while not nodes.isEmpty():
        x = nodes.withColumn("slot", F.floor(F.col("slot") / FRAGMENTS))
        tables.append(common.written(x.groupBy("slot").applyInPandas(_merge_part, _FOLDED), "merkle-merge"))
        nodes = tables[-1].filter("kind = 'node'")
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    need = folded.filter("kind = 'need'").select(F.col("slot").alias("part"), "tree", "level", "at")
    return every.filter("kind = 'root'").select("tree", "hash"), need.join(every.filter("kind = 'run'").select("tree", "level", "at", "run"), ["tree", "level", "at"])


class _Paths:
    """Ways from a leaf to the root, of leaves in order: what the last leaf's path shares isn't made again."""

    def __init__(self, levels, needed: dict[tuple[int, int], list[str]], total: int):
        self.levels, self.needed, self.sizes, self.last = levels, needed, [total], {}
        while self.sizes[-1] > 1:
            self.sizes.append(runs(self.sizes[-1]))

    def run(self, level: int, r: int) -> list[str]:
        if (level, r) in self.needed:
            return self.needed[level, r]
        at, nodes = self.levels[level]
        return nodes[r * ARITY - at : (r + 1) * ARITY - at]

    def above(self, level: int, i: int) -> list[tuple[str, str]]:
        """The siblings before and after the node and each of its ancestors, joined."""
        if self.sizes[level] == 1:
            return []
        if self.last.get(level, (None,))[0] != i:
            run, j = self.run(level, i // ARITY), i % ARITY
            self.last[level] = i, [("".join(run[:j]), "".join(run[j + 1 :])), *self.above(level + 1, i // ARITY)]
        return self.last[level][1]


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def _proofs(leaves: pd.DataFrame, help_: pd.DataFrame):
    """(row, tree, place in the tree, path) of the leaves of a partition, in order."""
    needed: dict[int, dict] = defaultdict(dict)
    for r in help_[help_["kind"] == "run"].itertuples():
        needed[int(r.tree)][int(r.level), int(r.at)] = list(r.run)
    parts = help_[help_["kind"] == "part"].sort_values("first")
    for tree, at, total, rows in _stretches(leaves, parts):
        paths = _Paths(fold(at, [h.hex() for h in rows["leaf"]], total)[0], needed[tree], total)
        for i, row in enumerate(rows.itertuples()):
            yield row, tree, at + i, paths.above(0, at + i)


_PATH = "array<struct<before:string,after:string>>"


def _top(key: tuple, leaves: pd.DataFrame, help_: pd.DataFrame) -> pd.DataFrame:
    """Of each tree: the path from its root to the manifest's root."""
    out = [(i, row.leaf.hex(), [{"before": a, "after": b} for a, b in path], folded(row.leaf.hex(), path)) for row, _, i, path in _proofs(leaves, help_)]
    return pd.DataFrame(out, columns=["tree", "subroot", "path", "root"])


def _leaf_rows(key: tuple, leaves: pd.DataFrame, help_: pd.DataFrame) -> pd.DataFrame:
    tops = {r.tree: (r.subroot, r.root, [(p["before"], p["after"]) for p in r.path]) for r in help_[help_["kind"] == "top"].itertuples()}
    out = []
    for row, tree, _, path in _proofs(leaves, help_):
        subroot, root, rest = tops[tree]
        path, leaf = path + rest, row.leaf.hex()
        back = folded(leaf if row.tampered is None else row.tampered.hex(), path)
        out.append((row.id, leaf, subroot, root, digest("".join(a + b for a, b in path)), back, back == root))
    return pd.DataFrame(out, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _help(parts: DataFrame, needed: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    out = parts.withColumn("kind", F.lit("part")).unionByName(needed.withColumn("kind", F.lit("run")), allowMissingColumns=True)
    if tops is None:
        return out
    mine = parts.select("part", "tree").join(tops, "tree")
    return out.unionByName(mine.withColumn("kind", F.lit("top")), allowMissingColumns=True)


def field(name: str, value: Column | None = None) -> Column:
    """`-` if null, else the UTF-8 bytes, a colon and the value as text."""
    v = (F.col(f"`{name}`") if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_hash(fields: list[str], changed: dict[str, Column] | None = None) -> Column:
    return F.sha2(F.concat(*[field(f, (changed or {}).get(f)) for f in fields]), 256)


def manifest(rows: DataFrame, fields: list[str], by: str, order: str, changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """id (the column `order`), leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    A leaf hashes the fields; trees are the values of `by` (null is a tree, the
    first), leaves ascend by `order` (null first; rows with equal keys by their
    hash, so repeated rows are leaves of their own). Where `when` is true, the
    row's proof is checked with the hash of the `changed` columns instead of the
    original: verified tells whether it leads to the root all the same. The
    hashes of whole texts are made where they are read; they alone are
    shuffled, so long texts cost nothing more. Empty texts and nulls differ
    (`0:` and `-`). An empty table has no rows and no root. Other columns of
    rows, of any name, are not looked at.
    """
    common.session(rows.sparkSession)
    bad = F.when(F.coalesce(when, F.lit(False)), F.unhex(leaf_hash(fields, changed))) if when is not None else F.lit(None).cast("binary")
    x = rows.select(F.col(f"`{by}`").cast("string").alias("group"), F.col(f"`{order}`").cast("long").alias("id"), F.unhex(leaf_hash(fields)).alias("leaf"), bad.alias("tampered"))
    x = x.withColumn("salt", F.monotonically_increasing_id())  # equal rows may stand in any order, and needn't lie in one partition
    x = common.written(x, "merkle-rows")  # ranges are found from a sample, for which texts aren't read again
    keys = [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("salt")]
    leaves = common.numbered(x, keys, common.parts(x.count(), LEAVES), "merkle-leaves").drop("salt")
    found = common.written(common.pieces(leaves, "group"), "merkle-parts")

    groups = found.groupBy("group").agg(F.sum("n").alias("rows"))
    ranked = common.numbered(groups, [F.col("group").asc_nulls_first()], common.parts(found.count(), LEAVES), "merkle-trees").withColumn("one", F.lit(0))
    spans = common.written(common.pieces(ranked, "one"), "merkle-tree-parts")
    ranks = ranked.join(spans.select("part", "first", "before"), "part").select(F.col("group").alias("g"), (F.col("idx") - F.col("first") + F.col("before")).alias("tree"))
    parts = common.written(found.join(ranks, F.col("group").eqNullSafe(F.col("g"))).select("part", "tree", "first", "n", "before", "total"), "merkle-pieces")

    small = leaves.select("part", "idx", "leaf")
    roots, needed = reduced(small, parts)
    upper = ranked.join(spans.select("part", "first", "before"), "part").select("part", "idx", (F.col("idx") - F.col("first") + F.col("before")).alias("tree"))
    upper = common.written(upper.join(roots, "tree").select("part", "idx", F.unhex("hash").alias("leaf")), "merkle-subroots")
    spans = spans.select("part", F.lit(0).cast("long").alias("tree"), "first", "n", "before", "total")
    _, above = reduced(upper, spans)
    tops = upper.groupBy("part").cogroup(_help(spans, above).groupBy("part")).applyInPandas(_top, f"tree long, subroot string, path {_PATH}, root string")
    tops = common.written(tops, "merkle-tops")

    texts = leaves.drop("group").withColumn("id", F.col("id").cast("string"))  # a column of numbers and nulls becomes one of floats
    out = texts.groupBy("part").cogroup(_help(parts, needed, tops).groupBy("part")).applyInPandas(_leaf_rows, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumn("id", F.col("id").cast("long"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document; where 3 divides the crc32 of its id (a null id's doesn't), the text checked is the lower-cased one."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, FIELDS, "lang", "doc_id", {"text": F.translate("text", _A, _A.lower())}, third).withColumnRenamed("id", "doc_id")


_F = ", ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" if f != "text" else "{text}" for f in FIELDS)
_T = "coalesce(strlen({0}) || ':' || {0}, '-')"
SQL = f"""
WITH RECURSIVE src AS (SELECT doc_id, lang, sha256(concat({_F.format(text=_T.format('text'))})) AS leaf,
  CASE WHEN {common.crc32_sql('doc_id')} % 3 = 0 THEN sha256(concat({_F.format(text=_T.format(f"translate(text, '{_A}', '{_A.lower()}')"))})) END AS bad FROM documents),
leaves AS (SELECT *, tree * 1000000000000 + pos AS r FROM (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM src) x),
nodes(tree, level, pos, hash, size) AS (SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL SELECT tree, any_value(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(size) + 7) // 8 FROM nodes WHERE size > 1 GROUP BY tree, pos // 8),
tops(level, pos, hash, size) AS (SELECT 0, tree - 1, hash, count(*) OVER () FROM nodes WHERE size = 1
  UNION ALL SELECT any_value(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(size) + 7) // 8 FROM tops WHERE size > 1 GROUP BY pos // 8),
height AS (SELECT tree, max(level) AS h FROM nodes GROUP BY tree),
every AS (SELECT tree, level, pos, hash, size FROM nodes WHERE size > 1
  UNION ALL SELECT tree, h + level, pos, hash, size FROM tops, height WHERE size > 1),
beside AS (SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 GROUP BY ALL),
up(id, tree, level, pos, hash, proof) AS (SELECT r, tree, 0, CASE WHEN h = 0 THEN tree - 1 ELSE pos END, coalesce(bad, leaf), '' FROM leaves JOIN height USING (tree)
  UNION ALL SELECT id, u.tree, u.level + 1, CASE WHEN u.level + 1 = h THEN u.tree - 1 ELSE u.pos // 8 END, sha256(concat(l, hash, r)), concat(proof, l, r)
   FROM up u JOIN height USING (tree) JOIN beside b ON b.tree = u.tree AND b.level = u.level AND b.pos = u.pos),
last AS (SELECT id, arg_max(hash, level) AS hash, arg_max(proof, level) AS proof FROM up GROUP BY id)
SELECT doc_id, leaf, s.hash AS subroot, t.hash AS root, sha256(proof) AS proof_sha256, last.hash AS folded_root, last.hash = t.hash AS verified
FROM leaves JOIN last ON id = r JOIN (SELECT tree, hash FROM nodes WHERE size = 1) s USING (tree), (SELECT hash FROM tops WHERE size = 1) t
"""
