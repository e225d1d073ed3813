"""Writes that can be repeated: batches written once, compaction, orphans; the hook for external models."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder named in spark.checkpoint.dir, which driver and executors share; removed at the end.

    Where that is unset, a temporary folder serves a local session; on a cluster it is an error.
    """
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set")
        top = f"file://{tempfile.mkdtemp(prefix='cluelake-')}"
    path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    except Exception:  # the session has ended already
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a scratch table and read back, which cuts their lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The files of a table's folder, without those that readers pass over."""
    fs, p = _fs(spark, folder)
    return [f.getPath().toString() for f in fs.listStatus(p) if not f.getPath().getName().startswith(("_", "."))]


def copied(spark: SparkSession, file: str, to: list[str]) -> None:
    """Copies of a file."""
    fs, p = _fs(spark, file)
    for other in to:
        spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, *_fs(spark, other), False, spark.sparkContext._jsc.hadoopConfiguration())


def touched(spark: SparkSession, folder: str, at_ms: int) -> None:
    """Sets the time of every file of a folder, by which a stream of files takes them in turn."""
    fs, p = _fs(spark, folder)
    for f in fs.listStatus(p):
        fs.setTimes(f.getPath(), at_ms, -1)


def write_batch(tables: dict[str, DataFrame], folder: str, batch: str) -> bool:
    """Writes all tables of a batch, or none: to a staging folder, which is renamed when every table is complete. False if the batch is there already."""
    spark = next(iter(tables.values())).sparkSession
    fs, final = _fs(spark, f"{folder}/batch={batch}")
    if fs.exists(final):
        return False
    _, staging = _fs(spark, f"{folder}/_staging-{batch}")
    fs.delete(staging, True)
    for name, t in tables.items():
        t.write.parquet(f"{folder}/_staging-{batch}/{name}")
    return bool(fs.rename(staging, final))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of all complete batches."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/batch=*/{name}")


def stream_sink(folder: str, split: Callable[[DataFrame], dict[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each micro-batch is split in tables and written once, also when it is replayed."""
    return lambda df, n: write_batch(split(df), folder, str(n)) and None


def compact(spark: SparkSession, path: str, to: str, n_files: int) -> None:
    """Rewrites Parquet in fewer files."""
    spark.read.parquet(path).coalesce(n_files).write.parquet(to)


def orphans(files: DataFrame, state: DataFrame) -> DataFrame:
    """Stored episodes (episode_id) whose work isn't complete, to be made anew."""
    return files.join(state.filter("status <> 'COMPLETED'").select("episode_id"), "episode_id", "left_semi")


def with_model(df: DataFrame, call=None, schema: str | None = None) -> DataFrame:
    """The place of an external model: call maps batches of pandas frames; without one rows stay as they are."""
    return df if call is None else df.mapInPandas(call, schema or df.schema)


def routed(rows: DataFrame, quality: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) rows by the gate's verdict on their episode."""
    ok = quality.filter("accepted").select("episode")
    return rows.join(ok, "episode", "left_semi"), rows.join(ok, "episode", "left_anti")


def gpu_load(samples: DataFrame) -> DataFrame:
    """Peak and mean of samples (episode, used_mb, pct), of a table or of a stream."""
    return samples.groupBy("episode").agg(F.max("used_mb").alias("peak_mb"), F.avg("pct").alias("mean_pct"))
