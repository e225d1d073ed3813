"""Operator 9 against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cluelake.llm import scoring, segments


def toks(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7


def mixture(rows, rounds=60):
    """Weights of each row of estimates, by expectation maximisation over every single held-out token."""
    w = [0.8 / (len(rows[0]) - 1)] * (len(rows[0]) - 1) + [0.2]
    for _ in range(rounds):
        total = [0.0] * len(w)
        for p in rows:
            all_ = sum(a * b for a, b in zip(p, w))
            for i in range(len(w)):
                total[i] += p[i] * w[i] / all_
        w = [x / len(rows) for x in total]
        w[-1] = max(w[-1], scoring.FLOOR)
        w = [x / sum(w) for x in w]
    return w


def brute(rows, order):
    """Counts, weights and scores with nothing but loops and floats; no estimate is rounded."""
    count, docs = Counter(), 0
    for d, t in rows:
        if fold(d) != 2:
            docs += 1
            w = ["<b>"] * (order - 1) + toks(t)
            for i in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    count[tuple(w[i - k + 1 : i + 1])] += 1
    n, v = sum(c for g, c in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)

    def context(g):
        h = g[:-1]
        return n if not h else docs if set(h) == {"<b>"} else count[h]

    def estimates(w, i, less):
        out = []
        for k in range(order, 0, -1):
            g = tuple(w[i - k + 1 : i + 1])
            c = context(g) - less
            out.append((count[g] - less) / c if c > 0 else 0.0)
        return [*out, 1 / (v + 1)]

    def bucket(w, i, less):
        c = context(tuple(w[i - order + 1 : i + 1])) - less if order > 1 else 0
        return 1 + int(math.floor(math.log2(c))) if c > 0 else 0

    held = defaultdict(list)
    for d, t in rows:
        if fold(d) != 2:
            w = ["<b>"] * (order - 1) + toks(t)
            for i in range(order - 1, len(w)):
                held[bucket(w, i, 1)].append(estimates(w, i, 1))
    start = [0.8 / order] * order + [0.2]
    lam = {b: mixture(x) for b, x in held.items()}
    zero = lam.get(0, start)
    if order > 1:
        zero = [0.0, *zero[1:]]
        lam[0] = [x / max(sum(zero), 1e-12) for x in zero]
    out = []
    for d, t in rows:
        w = ["<b>"] * (order - 1) + toks(t)
        x = w[order - 1 :]
        base = sum(math.log10((count[(b,)] + 1) / (n + v + 1)) for b in x)
        score = 0.0
        for i in range(order - 1, len(w)):
            score += math.log10(sum(a * b for a, b in zip(lam.get(bucket(w, i, 0), start), estimates(w, i, 0))))
        out.append((d, fold(d) == 2, len(x), sum(count[(b,)] > 0 for b in x), n, base, score))
    return out


def corpus(n=60):
    r = random.Random(3)
    vocab = ["the", "The", "of", "é", "É", "naïve", "x" * 5000, "x" * 4999, "a", "b", "c", "dd", "zz."]
    rows = [(i, r.choice([" ", "\n", "\t "]).join(r.choices(vocab, weights=range(13, 0, -1), k=r.randint(0, 20)))) for i in range(n)]
    return rows + [(70, None), (71, ""), (None, "the of"), (5, rows[5][1]), (72, " lead trail ")]


@pytest.mark.parametrize("size, order", [(200, 2), (8_000_000, 2), (500, 1), (500, 3)])
def test_scores_equal_brute_force(spark, monkeypatch, size, order):
    monkeypatch.setattr(segments, "SEGMENT", size)
    monkeypatch.setattr(scoring, "BUCKET", 40)
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, extra int, score string").repartition(3)
    got, want = [tuple(x) for x in scoring.scores(df, order).collect()], brute(rows, order)
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    assert len(got) == len(want)
    for g, e in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == e[:5]
        # cells hold the means of estimates that differ by half an octave at most
        assert g[5] == pytest.approx(e[5], abs=1e-6) and g[6] == pytest.approx(e[6], rel=2e-3, abs=2e-3)


def test_weights_of_single_rows_are_those_of_the_loop():
    r = random.Random(4)
    p = [[r.choice([0.0, r.random()]), r.random() / 5, 0.01] for _ in range(80)]
    got = scoring.weights(np.full(80, 3), np.array(p), np.ones(80, int))
    assert got[3] == pytest.approx(mixture(p), abs=1e-9)


def test_learns_that_bigrams_help(spark):
    """Text made by a chain: the mixture of orders is better on held-out documents than the base model."""
    r = random.Random(8)
    after = {w: r.sample(range(60), 3) for w in range(60)}
    rows = []
    for d in range(300):
        w = [r.randrange(60)]
        for _ in range(40):
            w.append(r.choice(after[w[-1]]))
        rows.append((d, " ".join(f"w{x}" for x in w)))
    got = scoring.scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert len(got) > 20
    assert all(x.score / x.n_tokens > x.base_score / x.n_tokens + 0.8 for x in got)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert scoring.scores(df).count() == 0
    one = scoring.scores(spark.createDataFrame([(4, "a b")], "doc_id long, text string")).collect()
    assert len(one) == 1 and math.isfinite(one[0].score)
