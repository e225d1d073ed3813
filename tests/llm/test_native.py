"""Operators 5 and 7 against brute force, with nulls, repeats, empty and long texts, and clashing column names."""

import hashlib
import random
import re

from cluelake.llm import decontam, quality


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def leaks(rows, items):
    out = []
    for d, t in rows:
        w, hit, found = item_words(t), set(), set()
        for i, x in items:
            v = item_words(x)
            k = min(10, len(v))
            grams = {tuple(v[s : s + k]) for s in range(len(v) - k + 1)} if v else set()
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in grams:
                    hit.update(range(s, s + k))
                    found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark):
    r = random.Random(2)
    word = lambda: r.choice(["the", "of", "é", "É", "Zoo", "x9", "naïve", "a"]) if r.random() < 0.6 else "".join(r.choice("abcdeé") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(r.choice([1, 2, 9, 10, 11, 25])))) for i in range(20)] + [(20, None), (21, ""), (22, "..."), (10, "The of THE of the of the of the of")]
    rows = []
    for i in range(60):
        w = [word() for _ in range(r.randint(0, 60))]
        if i % 2:
            k = r.randint(0, len(w))
            w[k:k] = [r.choice([" ", ", "]).join((items[r.randrange(20)][1] or "").upper().split(" "))]
        rows.append((i, r.choice([" ", ".\n", "-"]).join(w)))
    rows += [(70, None), (71, ""), (72, "\x00 . "), (None, rows[1][1]), (3, rows[3][1]), (73, "the of " * 3000)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, row string, pos int").repartition(3)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, row string")
    want = leaks(rows, items)
    assert sum(x[5] for x in want) > 10
    assert sorted([tuple(x) for x in decontam.report(docs, bench).collect()], key=repr) == want
    assert decontam.report(docs.filter("false"), bench).count() == 0
    assert not any(x.contaminated for x in decontam.report(docs, bench.filter("false")).collect())
    dirty = {(d, t) for (d, t) in rows if leaks([(d, t)], items)[0][5]}
    left = decontam.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted([(x.doc_id, x.text) for x in left.collect()], key=repr) == sorted([x for x in rows if x not in dirty], key=repr)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one two three four"), (3, "four three two one")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    ids = lambda slop: sorted({sizes[h.row] for h in decontam.search(docs, bench, 10, slop)[1].collect()})
    sizes = {x.row: x.doc_id for x in decontam.search(docs, bench)[0].collect()}
    assert ids(0) == [2] and set(ids(1)) >= {1, 2} and 3 not in ids(1)


def measures(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    rep = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    n, dup = len(w), len(lines) - len(set(lines))
    chars, signs = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t))
    base = n < 50 or 100 * len(rep) > 50 * n
    failed = base or 10 * signs > chars or 2 * dup > len(lines) or chars < 2 * n or chars > 20 * n
    return n, chars, signs, dup, len(rep), base, failed


def test_quality(spark):
    r = random.Random(4)
    rows = []
    for i in range(120):
        w = [r.choice("abcdefghé") + r.choice("ijklmn") + r.choice("opqrstu") + r.choice([""] * 20 + ["\n", "#"]) for _ in range(r.randint(30, 160))]
        rows.append((i, " ".join(w), "bad" if i % 4 == 0 else f"s{i % 5}"))
    rows = [(d, t[:60] if s == "bad" else t, s) for d, t, s in rows]
    rows += [(200, None, "s1"), (201, "", None), (202, rows[5][1], None), (5, rows[5][1], "s0"), (None, rows[6][1], "s1"), (203, "word " * 5000, "s2"), (204, rows[7][1], "bad")]
    m = [(d, s, *measures(t)) for d, t, s in rows]
    hosts = {s: [x[8] for x in m if x[1] == s] for s in {x[1] for x in m}}
    rates = [sum(v) / len(v) for v in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((x - mean) ** 2 for x in rates) / len(rates)
    z = max(1, min(1000, mean * (1 - mean) / var - 1))
    ok = {s: (sum(v) + mean * z) / (len(v) + z) <= 0.75 for s, v in hosts.items()}
    assert not ok["bad"] and sum(ok.values()) >= 4
    want = sorted([(d, *x[:5], x[5], not x[5] and ok[s]) for d, s, *x in m], key=repr)
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in rows], "doc_id long, text string, source string, host int").repartition(3)
    assert sorted([tuple(x) for x in quality.verdicts(df).collect()], key=repr) == want
    kept = quality.kept(df)
    assert kept.columns == df.columns
    assert sorted(repr(x.doc_id) for x in kept.collect()) == sorted(repr(x[0]) for x in want if x[7])
    assert quality.verdicts(df.filter("false")).count() == 0
