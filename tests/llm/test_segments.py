"""Segments on disk."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cluelake.llm import common, segments


def test_a_row_group_holds_one_segment(spark, monkeypatch):
    """So that neither the writer nor a reader holds more than one of them, however many a task has."""
    monkeypatch.setattr(segments, "SEGMENT", 5_000)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100).alias("text")).coalesce(1)
    try:
        seg = segments.pack(docs, F.lit(0))
    finally:
        common.session(spark)
    assert seg.count() > 15
    files = glob.glob(f"{common._read_by(seg)[0][1].removeprefix('file://')}/*.parquet")
    groups = [m.row_group(i).num_rows for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    assert groups == [1] * seg.count()
