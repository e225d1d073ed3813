"""Operator 2: round trips, and audits of damaged replicas."""

import gzip
import hashlib
import random

from pyspark.sql import functions as F

from cluelake.llm import warc

ROWS = [(i, f"http://h/{i}", f"<p>{'é' * (i % 50)}</p>\r\n\r\nWARC/1.1\r\n") for i in range(300)] + [(None, None, None), (5, "http://h/5", ""), (400, "u", "x" * 300_000)]


def pages(spark):
    return spark.createDataFrame([(*r, "y") for r in ROWS], "page_id long, url string, html string, hash string")


def test_audit_locates_damage(spark):
    got = warc.audited(pages(spark), F.col("page_id") % 101 == 7).collect()
    assert len(got) == len(ROWS)
    want = sorted((repr(p), len(raw := warc.record(p, u, h)), hashlib.sha256(raw).hexdigest(), p is not None and p % 101 == 7) for p, u, h in ROWS)
    assert sorted((repr(r.page_id), r.n_bytes, r.record_sha256, r.corrupt) for r in got) == want
    assert not any(r.corrupt for r in warc.audited(pages(spark), F.lit(None).cast("boolean")).collect())
    assert warc.audited(pages(spark).filter("false"), F.lit(True)).count() == 0


def test_truncated_and_missing(spark, tmp_path):
    src = pages(spark).withColumn("flip", F.lit(False))
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    la = warc.leaves(warc.write(src, a, 3), a)
    fb = warc.write(src, b, 3)
    f = fb.orderBy("file_no").first()
    raw = open(f.file, "rb").read()
    open(f.file, "wb").write(raw[:-200_000] if len(raw) > 250_000 else raw[:-50])
    lb = warc.leaves(fb, b, la)
    found = warc.audit(warc.tree(la), warc.tree(lb)).collect()
    assert found and {r.file_no for r in found} == {f.file_no} and all(r.status in ("changed", "missing") for r in found)
    ta = warc.tree(la)
    assert warc.audit(ta, ta).count() == 0


def test_pages_are_shuffled_once_and_kept_packed(spark, tmp_path):
    """For both replicas; any reader of gzip finds the records one after another."""
    r = random.Random(3)
    rows = [(i, "u", "".join(r.choice("0123456789abcdefghijklmnopqrstuvwxyz") for _ in range(4000))) for i in range(300)]
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    src = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).localCheckpoint()
    before = written()
    assert sorted(x.page_id for x in warc.audited(src, F.col("page_id") == 7).collect() if x.corrupt) == [7]
    assert written() - before < 1.5 * 4000 * len(rows)
    files = warc.write(src.withColumn("flip", F.col("page_id") == 7), f"file://{tmp_path}/a", 2)
    whole = lambda d: [open(f.file, "rb").read() for f in d.orderBy("file_no").collect()]
    one, two = whole(files), whole(warc.replicate(files, f"file://{tmp_path}/b"))
    assert b"".join(map(gzip.decompress, one)) == b"".join(warc.record(*x) for x in rows)
    assert sum(x != y for a, b in zip(one, two, strict=True) for x, y in zip(a, b, strict=True)) == 1
    assert sum(map(len, one)) < 0.8 * 4000 * len(rows)
