"""Operator 3 against brute force."""

import random
import re

import numpy as np

from cluelake.llm import common, setjoin
from cluelake.llm.segments import Segment


def shingles(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 4 >= max(len(sets[i]), len(sets[j])) * 3:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * len(sets[i] | sets[j]):
                    up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None) if sets[i] else (d, 0, d))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(r.randint(1, 6)))
    rows, i = [], 0

    def add(w):
        nonlocal i
        rows.append((i, r.choice([" ", "\n"]).join(w)))
        i += 1

    for _ in range(n):  # clusters of near copies, with sizes around every band edge
        w = [word() for _ in range(r.choice([1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 17, 20, 30, 60, 150, 400]))]
        add(w)
        for _ in range(r.choice([0, 0, 1, 3])):
            v = list(w)
            for _ in range(max(1, len(v) // r.choice([12, 25, 40, 80]))):
                k = r.randrange(len(v))
                v[k : k + r.choice([0, 1, 1])] = [word()] * r.choice([0, 1])
            add(v or ["x"])
    base = [word() for _ in range(80)]
    for _ in range(70):  # a group that shares every segment with more than GROUP others
        v = list(base)
        for _ in range(r.randint(0, 3)):
            v[r.randrange(80)] = word()
        add(v)
    passage = [word() for _ in range(60)]
    for _ in range(60):  # a passage in many documents of other words
        k = r.choice([3, 6, 8, 15, 60])
        add([word() for _ in range(k)] + passage + [word() for _ in range(k)])
    rows += [(9001, None), (9002, ""), (9003, " \n\t"), (9004, rows[0][1].upper()), (3, rows[40][1]), (None, rows[41][1]), (9005, "x" * 9000)]
    return rows


def test_groups_equal_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fp string, n int").repartition(3)
    got = sorted([tuple(x) for x in setjoin.groups(df).collect()], key=repr)
    want = brute(rows)
    assert len(got) == len(want)
    assert [x for x in zip(got, want) if x[0] != x[1]][:5] == []


def segment(rows):
    raw = [(t or "").encode() for _, t in rows]
    starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in raw]))).astype("<i8")
    n = len(rows)
    return Segment({"seg": 0, "ids": np.arange(n, dtype="<i8").tobytes(), "known": b"\1" * n, "extra": bytes(8 * n), "starts": starts.tobytes(), "data": b" ".join(raw) + b" "})


def test_no_link_is_lost_before_verification():
    """Every link has a shared segment, or both sets are deficient by margin alone."""
    rows = corpus(2, 400)[: 900]
    x = setjoin.Sets(segment(rows))
    sets = [shingles(t) for _, t in rows]
    assert x.n.tolist() == [len(s) for s in sets]
    sent, margins = [set() for _ in rows], []
    for _, sig, doc, margin in setjoin._roles(x):
        margins.append(margin)
        for a, b in zip(sig.tolist(), doc.tolist()):
            sent[b].add(a)
    seen = 0
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and sets[i] != sets[j]:
                seen += 1
                lost = all(min(m[k] for m in margins) < 0 for k in (i, j))
                assert sent[i] & sent[j] or lost, (len(sets[i]), len(sets[j]), both)
    assert seen > 300
    big = x.n >= 60
    assert (np.minimum(*margins)[big] < 0).mean() < 0.05


def test_no_rows(spark):
    assert setjoin.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_noisy_copies_and_passages(spark, monkeypatch):
    """Groups whose sets stand at, and around, the limit from their source and from each other, with the smallest groups of segments."""
    monkeypatch.setattr(setjoin, "GROUP", 2)
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 6)))
    rows = []
    for size, copies in ((60, 50), (150, 60), (30, 30)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            v = list(base)
            for _ in range(r.randint(0, size // 12)):
                v[r.randrange(size)] = word()
            rows.append((len(rows), " ".join(v)))
    passage = [word() for _ in range(70)]
    for _ in range(40):
        rows.append((len(rows), " ".join([word() for _ in range(r.randint(5, 30))] + passage)))
    got = sorted([tuple(x) for x in setjoin.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()], key=repr)
    want = brute(rows)
    assert [x for x in zip(got, want) if x[0] != x[1]][:5] == []
    assert 5 < len({c for _, _, c in want}) < 150


def test_representatives(spark):
    """The row of the least id of each group stays; nulls come last; rows without shingles stay; columns keep names and values."""
    t = "one two three four five six seven eight"
    rows = [(5, t, "a"), (3, t.upper(), "b"), (None, t, "c"), (7, None, "d"), (7, "", "e"), (9, "other words are here", "f"), (9, "other words are here", "f")]
    got = setjoin.representatives(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect()
    assert sorted(x["row"] for x in got) == ["b", "d", "e", "f"]
    assert {x["row"]: x["text"] for x in got}["b"] == t.upper()


def test_stored_rows_are_not_written_again(spark, tmp_path):
    """A stored table's rows are known by their places in its files; rows that are equal in all columns as well."""
    rows = [(2, "one two three"), (1, "one two three"), (1, "one two three"), (3, None), (3, None), (4, "four five")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    before = set(common._paths)
    got = setjoin.representatives(spark.read.parquet(f"{tmp_path}/docs"), stored=True).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, "one two three"), (3, None), (3, None), (4, "four five")]))
    assert not [p for p in common._paths if p not in before and "/docs-" in p[1]]
