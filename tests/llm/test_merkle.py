"""Operator 13 against a plain tree, with partitions of a few leaves, and the laws of its monoid."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cluelake.llm import merkle
from tests.llm.test_sql import oracle, rows

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, part string"


def leaf(row, lower=False):
    out = []
    for i, v in enumerate(row):
        if lower and i == 4 and v is not None:
            v = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in v)
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return H(*out)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([H(*x[i : i + 8]) for i in range(0, len(x), 8)])
    return out


def path(lv, i):
    out = []
    for nodes in lv[:-1]:
        lo = i // 8 * 8
        out.append((nodes[lo:i], nodes[i + 1 : lo + 8]))
        i //= 8
    return out


def brute(docs):
    key = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    langs = sorted({d[2] for d in docs}, key=key)
    trees = {g: sorted((d for d in docs if d[2] == g), key=lambda d: (key(d[0]), leaf(d))) for g in langs}
    each = {g: levels([leaf(d) for d in t]) for g, t in trees.items()}
    top = levels([each[g][-1][0] for g in langs])
    out = []
    for n, g in enumerate(langs):
        for i, d in enumerate(trees[g]):
            p = path(each[g], i) + path(top, n)
            h = leaf(d, d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0)
            for a, b in p:
                h = H(*a, h, *b)
            out.append((d[0], leaf(d), each[g][-1][0], top[-1][0], H(*[x for a, b in p for x in a + b]), h, h == top[-1][0]))
    return sorted(out, key=repr)


def made(n, seed=1):
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "plain words", "With Capitals É", "x" * r.randint(0, 50), "A" * 200_000 if r.random() < 0.02 else "b"])
    docs = [(r.randint(-5, 3 * n), r.choice(["s1", None, "ü"]), r.choice(["en", "en", "en", "de", "", None, f"l{r.randint(0, 20)}"]), r.choice([None, r.randint(0, 99)]), text()) for _ in range(n)]
    return docs + docs[: n // 5] + [(None, None, None, None, None)] * 2 + [(None, "s", "en", 1, "Q")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, 7, "y") for d in docs], SCHEMA).repartition(5)


@pytest.mark.parametrize("n, leaves", [(1, 100_000), (9, 3), (700, 20), (700, 100_000)])
def test_equals_plain_tree(spark, monkeypatch, n, leaves):
    monkeypatch.setattr(merkle, "LEAVES", leaves)
    monkeypatch.setattr(merkle, "FRAGMENTS", 3)
    docs = made(n)
    assert sorted([tuple(x) for x in merkle.documents(frame(spark, docs)).collect()], key=repr) == brute(docs)


def test_one_document_and_none(spark):
    docs = [(6, "s", None, 3, "Abc")]
    assert [tuple(x) for x in merkle.documents(frame(spark, docs)).collect()] == brute(docs)
    assert merkle.documents(frame(spark, docs).filter("false")).count() == 0


def test_tampering_is_found_where_the_text_changes(spark):
    docs = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(300)]
    for x in merkle.documents(frame(spark, docs)).collect():
        assert x.verified == (not (zlib.crc32(str(x.doc_id).encode()) % 3 == 0 and x.doc_id % 2))


def test_sql_on_trees_of_all_sizes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 7)
    docs = made(150, 3)
    df = spark.createDataFrame([d for d in docs], "doc_id long, source string, lang string, n_chars long, text string").filter("doc_id IS NOT NULL")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("benchmark", "pages", "labels", "conversations"):
        df.limit(0).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    got, want = merkle.documents(df), oracle(merkle.SQL, str(tmp_path))
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def cut(total, bounds):
    at = [0, *sorted(b % (total + 1) for b in bounds), total]
    return [(a, b) for a, b in zip(at, at[1:]) if a < b]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 700), st.lists(st.integers(0, 10_000), max_size=6), st.randoms(use_true_random=False))
def test_fragments_merge_in_any_order(total, bounds, r):
    """Any split, merged in any grouping and order, gives the plain tree's root; the empty fragment changes nothing."""
    nodes = [H(str(i)) for i in range(total)]
    frags = []
    for a, b in cut(total, bounds):
        lv, left = merkle.fold(a, nodes[a:b], total)
        assert len(left) <= 14 * 5
        frags.append({(0, level, i): h for level, i, h in left} if b - a < total else {(0, len(lv) - 1, 0): lv[-1][1][0]})
    while len(frags) > 1:
        i, j = r.sample(range(len(frags)), 2)
        x, _ = merkle.merge(frags[i] | frags[j], {0: total})
        assert merkle.merge(x, {0: total})[0] == x
        frags = [f for k, f in enumerate(frags) if k not in (i, j)] + [x]
    assert list(frags[0].values()) == levels(nodes)[-1]
