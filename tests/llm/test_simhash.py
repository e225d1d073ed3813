"""Operator 12: fingerprints against a plain vote, rows against plain lists, the search against all pairs."""

import hashlib
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cluelake.llm import simhash

M64 = (1 << 64) - 1
SCHEMA = "doc_id long, text string, fingerprint int, tie string, part string"


def mix(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & M64
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & M64
    return h ^ (h >> 31)


def odd(n, seed):
    return [mix((i * 0x9E3779B97F4A7C15 + seed) & M64) | 1 for i in range(1, n + 1)]


def plain(text):
    """One term, one bit at a time."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return "0" * 32
    far, place, lanes, kinds = odd(4096, 11), odd(5, 91), odd(2, 92), odd(2, 93)
    word = lambda w: mix((sum((b + 1) * far[i] for i, b in enumerate(w)) + len(w) * far[7]) & M64)
    k = min(5, len(words))
    grams = [sum(word(w) * p for w, p in zip(words[i : i + k], place)) & M64 for i in range(len(words) - k + 1)]
    votes = [0] * 128
    for kind, terms in enumerate(([word(w) for w in words], grams)):
        for t in set(terms):
            weight = 1 + math.floor(math.log2(terms.count(t)))
            x = mix((t * kinds[kind]) & M64)
            raw = b"".join(mix((x * m) & M64).to_bytes(8, "little") for m in lanes)
            for i in range(128):
                votes[i] += weight if raw[i // 8] >> (7 - i % 8) & 1 else -weight
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):032x}"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab AZ\té\x1f\n", max_size=40)), max_size=5))
def test_fingerprints(texts):
    assert [p.hex() for p in simhash.fingerprints(texts)] == [plain(t) for t in texts]


def test_long_text():
    r = random.Random(1)
    text = " ".join(f"w{r.randint(0, 900)}" for _ in range(5000))
    assert simhash.fingerprints([text, text])[1].hex() == plain(text)
    huge = "word " * 2_000_000 + "end"
    assert simhash.fingerprints(["a b", huge, "a b"])[0] == simhash.fingerprints(["a b"])[0]


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def brute(rows, radius=simhash.RADIUS):
    rows = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    prints = [plain(t) for _, t in rows]
    out = []
    for i, (d, t) in enumerate(rows):
        t, u = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 3
        e = t[: len(t) - k] + u[:k]
        like = lambda a, b: 1 - distance(a, b) / 128
        asked = sum(q is not None and q % 50 == 0 and distance(p, prints[i]) <= radius for (q, _), p in zip(rows, prints))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[i], plain(e), like(prints[i], plain(e)), like(prints[i], prints[(i + 1) % len(rows)]), asked))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_queries"]


def run(df):
    return sorted([tuple(x) for x in simhash.report(df).select(*COLUMNS).collect()], key=repr)


def made(n, seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefé") for _ in range(r.randint(1, 6)))
    texts = [" ".join(word() for _ in range(r.choice([0, 1, 4, 5, 30, 90]))) for _ in range(n)]
    for i in range(0, n, 4):
        w = texts[i - 1].split(" ")
        w[r.randrange(len(w))] = "changed"
        texts[i] = " ".join(w)
    texts[12] = texts[22] = texts[23] = " ".join(word() for _ in range(400))
    texts[32] = texts[22] + " more"
    texts[3], texts[7], texts[8] = None, "", " \n"
    return [(i * 5 - 10, t) for i, t in enumerate(texts)] + [(None, "no id, but words")]


@pytest.mark.parametrize("parts", [1, 7])
def test_rows(spark, parts):
    rows = made(90)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*x, 3, "y", "z") for x in rows], SCHEMA).repartition(5)
        want = brute(rows)
        assert sum(x[7] > 1 for x in want) > 0
        assert run(df) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_equal_ids_repeats_one_and_none(spark):
    same = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (0, "other words")]
    df = spark.createDataFrame([(*x, 3, "y", "z") for x in same], SCHEMA)
    assert run(df) == brute(same)
    tied = spark.createDataFrame([(7, t, 3, "y", "z") for t in ("a b", "c d", "e f")], SCHEMA)
    assert run(tied) == run(tied.repartition(3)) and len(run(tied)) == 3
    assert run(df.limit(1)) == brute(same[:1])
    assert run(df.filter("false")) == []


@pytest.mark.parametrize("radius, n_blocks", [(0, 2), (1, 4), (3, None), (4, 6), (6, 8)])
def test_search_finds_all(spark, radius, n_blocks):
    r = random.Random(radius)
    base = [r.getrandbits(128) for _ in range(12)]
    prints = {f"{x:032x}" for x in base}
    for x in base:  # copies at all distances about the radius
        for _ in range(12):
            y = x
            for b in r.sample(range(128), r.randint(0, radius + 2)):
                y ^= 1 << b
            prints.add(f"{y:032x}")
    prints = sorted(prints)
    asked = prints[::3]
    cut = None
    if n_blocks:
        at = [32 * i // n_blocks for i in range(n_blocks + 1)]
        cut = [(a, b - a) for a, b in zip(at, at[1:])]
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    got = [tuple(x) for x in simhash.search(df, df.filter(F.col("fingerprint").isin(asked)), radius, cut).collect()]
    want = [(q, p, distance(q, p)) for q in asked for p in prints if distance(q, p) <= radius]
    assert len(want) > len(asked) or radius == 0
    assert sorted(got) == sorted(want)


def test_blocks_grow_with_the_fingerprints():
    for n in (0, 10, 10**6, 10**11):
        cut = simhash.blocks(n, 4)
        assert sum(s for _, s in cut) == 32 and 4 * sum(sorted(s for _, s in cut)[: len(cut) - 4]) >= math.log2(n + 1)


def test_edits_are_nearer_than_strangers(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(20, 300)))) for i in range(200)]
    got = simhash.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert min(x.near_edited for x in got) > max(x.near_next for x in got) - 0.1
    assert sum(x.near_edited > 0.62 > x.near_next for x in got) > 190
