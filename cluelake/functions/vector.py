"""Distances of dense vectors held as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cluelake.sources.commit import scratch

#: Queries in a block, which the driver and every task hold (512 bytes each at 64 dimensions), and rows that meet it at once.
BLOCK, ROWS = 4096, 512


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine in [0, 1]; 1 for a zero vector; an error if lengths differ."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    d = F.when(norm == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - dot(a, b) / norm)))
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different length")).cast("double")).otherwise(d)


def nearest(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """qid, vec_id, distance, place: the k nearest rows (vec_id, embedding) of each query by cosine distance, ties to the lower id, itself left out.

    Exact: a block of queries goes to all tasks as one matrix, and every batch
    of rows keeps k candidates for each of them; only those are shuffled. More
    than a block of queries take a pass over the rows for each block, whose
    candidates are stored before the next one is fetched.
    """
    n_blocks = -(-queries.count() // BLOCK)
    if n_blocks <= 1:
        near = _candidates(queries, rows, k)
    else:
        spark, path = rows.sparkSession, scratch(rows.sparkSession, "nearest")
        for i in range(n_blocks):
            _candidates(queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == i), rows, k).write.mode("append").parquet(path)
        near = spark.read.parquet(path)
    w = Window.partitionBy("qid").orderBy("distance", "vec_id")
    return near.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= k)


def _candidates(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    found = queries.select("vec_id", "embedding").collect()  # a block at most, give or take the hash's unevenness
    of, e = np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], float)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b) if len(of) else 0, ROWS):
                part = b.iloc[start : start + ROWS]
                ids, a = part["vec_id"].to_numpy(), np.stack(part["embedding"].to_numpy()).astype(float)
                norm = np.linalg.norm(e, axis=1)[:, None] * np.linalg.norm(a, axis=1)[None, :]
                with np.errstate(divide="ignore", invalid="ignore"):
                    d = np.where(norm == 0, 1.0, np.clip(1 - e @ a.T / norm, 0, 1)).round(6)
                d[of[:, None] == ids[None, :]] = np.inf
                order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
                keep = np.take_along_axis(d, order, 1)
                out = pd.DataFrame({"qid": np.repeat(of, order.shape[1]), "vec_id": ids[order].ravel(), "distance": keep.ravel()})
                yield out[np.isfinite(out["distance"])]

    return rows.select("vec_id", "embedding").mapInPandas(best, "qid long, vec_id long, distance double")
