"""Operator 8 against brute force."""

import random

import numpy as np
import pytest

from cluelake.llm import suffixdedup


def brute(rows):
    value = lambda d: suffixdedup.NULL_ID if d is None else d
    least = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            least[s] = min(least.get(s, suffixdedup.NULL_ID), value(d))
    out = []
    for d, b in raw:
        off = bytearray(len(b))
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < value(d):
                off[i : i + 50] = b"\1" * 50
        spans = sum(off[i] and (i == 0 or not off[i - 1]) for i in range(len(b)))
        out.append((d, len(b), sum(off), spans, bytes(x for x, o in zip(b, off) if not o)))
    return sorted(out, key=repr)


def corpus(seed, n=50):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefé") for _ in range(r.randint(1, 8)))
    passages = [" ".join(word() for _ in range(r.randint(9, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        t = " ".join(r.choice([word(), word(), word(), word(), word(), r.choice(passages)[r.randint(0, 20) :]]) for _ in range(r.randint(0, 60)))
        rows.append((r.randint(0, 10**9), t))
    rows += [(7, rows[0][1]), (2**40, rows[1][1]), (8, None), (9, ""), (10, "short"), (None, rows[2][1]), (11, "a" * 400), (12, "b" + "a" * 300), (13, "ab" * 200 + "\0" * 80), (14, "x\0" * 60 + "\0" * 70)]
    rows += [(15, rows[3][1]), (15, rows[3][1]), (16, passages[0] * 2), (5, passages[0] + "\n" + passages[1])]
    return rows


@pytest.mark.parametrize("shard", [600, 4_000_000])
def test_shards_and_merge(monkeypatch, shard):
    monkeypatch.setattr(suffixdedup, "SHARD", shard)
    r = random.Random(shard)
    raw = list({bytes(r.choice(b"ab\0") for _ in range(r.randint(50, 90))) if r.random() < 0.5 else (b"abcab" * 30)[r.randint(0, 9) :][: r.randint(50, 99)] + bytes([r.randint(0, 255)]) for _ in range(60)})
    least = np.array([r.randint(0, 100) for _ in raw], np.int64)
    want = {}
    for x, d in zip(raw, least.tolist()):
        for i in range(len(x) - 49):
            want[x[i : i + 50]] = min(want.get(x[i : i + 50], 1000), d)
    assert suffixdedup._least_ids(raw, least).tolist() == [want[x[i : i + 50]] for x in raw for i in range(len(x) - 49)]


def test_dedup_equals_brute_force(spark):
    rows = corpus(4)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, kept string").repartition(3)
    got = sorted([(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixdedup.dedup(df).collect()], key=repr)
    want = brute(rows)
    assert len(got) == len(want) and sum(x[2] for x in want) > 2000
    assert [x for x in zip(got, want) if x[0] != x[1]][:2] == []
    assert suffixdedup.dedup(df.filter("false")).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_overlapping_snippets_of_one_passage(seed):
    r = random.Random(seed)
    some = lambda n: bytes(r.choice(b"abcdefgh ") for _ in range(n))
    passage = some(r.randint(120, 400))
    cut = lambda: passage[(a := r.randint(0, len(passage) - 60)) : a + r.randint(30, 113)]
    raw = [(some(r.randint(0, 20)) + cut() + some(r.randint(0, 20)))[:113] for _ in range(r.randint(5, 60))]
    raw = list(dict.fromkeys(x for x in raw if len(x) >= 50)) or [passage[:60]]
    least = np.array([r.randint(0, 100) for _ in raw], np.int64)
    want = {}
    for x, d in zip(raw, least.tolist()):
        for i in range(len(x) - 49):
            want[x[i : i + 50]] = min(want.get(x[i : i + 50], 1000), d)
    assert suffixdedup._least_ids(raw, least).tolist() == [want[x[i : i + 50]] for x in raw for i in range(len(x) - 49)]


def test_suffixes_are_in_order():
    r = random.Random(5)
    raw = [bytes(r.choice(b"ab\0") for _ in range(r.randint(1, 40))) for _ in range(50)]
    sym = np.concatenate([np.append(np.frombuffer(x, np.uint8).astype(np.uint16) + 1, 0) for x in raw]).astype(np.uint16)
    end = np.flatnonzero(sym == 0)
    key = lambda i: (sym[i : (e := end[np.searchsorted(end, i)])].tolist() + [0], e)
    assert suffixdedup.suffix_array(sym).tolist() == sorted(range(len(sym)), key=key)


def test_equals_sql_on_documents(spark):
    """Whole documents of the given tables, whose passages recur in changing contexts."""
    import duckdb

    path = "/root/testdata/sf0.01/documents.parquet"
    want = duckdb.sql(suffixdedup.SQL.replace("FROM documents", f"FROM '{path}'")).df().sort_values("doc_id").reset_index(drop=True)
    got = suffixdedup.digest(spark.read.parquet(path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got[list(want.columns)].astype(str).equals(want.astype(str))
