"""Operator 11 against plain nested dictionaries and against SQL, with small blocks, parts and pieces."""

import hashlib
import random
import re
import zlib

import pytest

from cluelake.llm import trie
from tests.llm.test_sql import oracle, rows

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, key int"


def own_turns(table):
    out = {}
    for c, turn, role, text in sorted((x for x in table if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def brute(table):
    own = own_turns(table)
    full = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - c % 20, [])[:h] + t[h:])
    members = {}
    for c, t in full.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for t in members:
        if t:
            kids[t[:-1]] += 1
    for t, m in members.items():
        s = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", t[-1][1])) if t else 0
        for d in range(len(t) + 1):
            leaves[t[:d]] += kids[t] == 0
            saved[t[:d]] += s
    ends = lambda t: hashlib.sha256(",".join(str(c) for c in sorted(members[t]) if full[c] == t).encode()).hexdigest()
    return sorted(((len(t), min(m), min(members[t[:-1]]) if t else None, len(m), kids[t], leaves[t], saved[t], ends(t)) for t, m in members.items()), key=repr)


COLUMNS = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(df):
    return sorted([tuple(x) for x in trie.prefixes(df).select(*COLUMNS).collect()], key=repr)


def made(seed):
    r = random.Random(seed)
    say = lambda: r.choice(["", None, "a b", "A  b\tc", "é\x0b x", "\n", "long " * 40])
    stems = [[(r.choice(["user", "assistant", None, ""]), say()) for _ in range(n)] for n in (2, 5, 9, 9)]
    table = []
    for c in [*range(0, 55), 81, 85, 100, 101, 119, 5000, 5001, 5019]:
        t = list(r.choice(stems))[: r.choice([1, 2, 3, 5, 9, 9])] + [("user", say()) for _ in range(r.choice([0, 0, 0, 1, 9]))]
        for i, (role, text) in enumerate(t):
            table.append((c, None if i == 0 and r.random() < 0.3 else i * 2, role, text))
        if r.random() < 0.2:
            table.append(table[-1])
    table += [(81, 1, "user", "x"), (81, 1, "user", "w")] + [(None, 1, "user", "nobody's")] * 3
    r.shuffle(table)
    return table


def frame(spark, table):
    return spark.createDataFrame([(*x, "y", 3, 4) for x in table], SCHEMA).repartition(4)


@pytest.mark.parametrize("seed, block, ids", [(2, 4, 7)])
def test_equals_nested_dictionaries(spark, monkeypatch, seed, block, ids):
    for name, v in (("BLOCK", block), ("IDS", ids), ("ROWS", 60)):
        monkeypatch.setattr(trie, name, v)
    table = made(seed)
    want = brute(table)
    assert max(x[0] for x in want if x[3] > 1) >= 8 and sum(x[3] > 1 for x in want) > 20  # copies share long prefixes
    assert run(frame(spark, table)) == want


def test_few_conversations_and_none(spark):
    one = [(5, 2, "user", "b"), (5, None, None, "a a"), (5, 9, "user", "c")]
    assert run(frame(spark, one)) == brute(one)
    turnless = [(c, 0, "user", "x") for c in range(21, 40)]  # conversations 20 is absent, so that many have no turn left
    want = brute(turnless)
    assert want[0][0] == 0 and want[0][7] != trie.EMPTY
    assert run(frame(spark, turnless)) == want
    assert run(frame(spark, one).filter("false")) == []


def test_long_turns_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 100)
    table = [(1, i, "user", f"turn {i}") for i in range(700)] + [(c, 0, "user", "word " * 100_000) for c in (40, 41, 44)]
    assert run(frame(spark, table)) == brute(table)


def test_sql(spark, tmp_path):
    df = spark.createDataFrame([x for x in made(3)], "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    for t in ("benchmark", "pages", "labels", "documents"):
        df.limit(0).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    got, want = trie.prefixes(df), oracle(trie.SQL, str(tmp_path))
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
