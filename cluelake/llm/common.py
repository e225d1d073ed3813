"""What the operators of this subpackage share: the shared folder, written tables, vectorised text hashing, and blobs.

A *blob* is a numpy array packed into a binary column. Operators that move
hundreds of millions of hashes move them as blobs, a row for each (shard,
bucket) instead of a row for each hash, so that the shuffle costs the bytes
of the hashes and no more.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows in an Arrow batch; with texts of a few kB this is 1-2 MB, and a batch of the longest texts stays under 100 MB.
ARROW_ROWS = 512

_own: dict[str, str] = {}
_paths: list[tuple[str, str]] = []
_staged: list[tuple[str, str]] = []
_shipped: set[str] = set()
_tables: dict[str, str] = {}


def session(spark: SparkSession) -> SparkSession:
    """Makes the package importable on the executors and keeps Arrow batches small."""
    key = spark.sparkContext.applicationId
    if key not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if not top.endswith(".zip") and os.path.isdir(top):
            out = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{os.path.basename(top)}.zip")
            with zipfile.ZipFile(out, "w") as z:
                for d, _, names in os.walk(top):
                    for n in names:
                        if n.endswith(".py"):
                            z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(top)))
            spark.sparkContext.addPyFile(out)
        _shipped.add(key)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share; a temporary one for a local session where it is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir isn't set")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = f"file://{tempfile.mkdtemp(prefix='cluelake-')}"
    return _own[key]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    _paths.append((spark.sparkContext.applicationId, path))
    return path


def _bare(path: str) -> str:
    return path.split(":", 1)[-1].lstrip("/")


def _read_by(docs: DataFrame) -> list[tuple[str, str]]:
    """Which of the paths that operators have written docs reads."""
    read = {_bare(os.path.dirname(f)) for f in docs.inputFiles()}
    return [p for p in _paths if any(r.startswith(_bare(p[1])) for r in read)]


def _drop(spark: SparkSession, gone: list[tuple[str, str]]) -> None:
    for own in gone:
        _remove(spark, own[1])
        _paths.remove(own)


def stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a pipeline whose result is written before the next one begins.

    It first removes what operators of earlier stages have left in the shared
    folder, but for what its own input reads.
    """

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held, app = _read_by(docs), spark.sparkContext.applicationId
        _drop(spark, [p for p in _staged if p[0] == app and p not in held and p in _paths])
        _staged[:] = [p for p in _staged if p[0] != app or p in held]
        collected(spark)
        before = len(_paths)
        out = f(spark, docs, sf_dir)
        _staged.extend(_paths[before:])
        return out

    return run


def discard(docs: DataFrame) -> None:
    """Removes what written() has stored for docs, which isn't read any more."""
    _drop(docs.sparkSession, _read_by(docs))


@contextlib.contextmanager
def only_result(spark: SparkSession):
    """Removes at its end what has been written inside it, but for the DataFrame that its function was given, and lets go of the shuffles."""
    before, result = len(_paths), []
    yield lambda df: result.append(df) or df
    held = [p for df in result for p in _read_by(df)]
    _drop(spark, [p for p in _paths[before:] if p not in held])
    collected(spark)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        if path in _tables:
            spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended already
        pass


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Cuts the lineage: writes the rows as Parquet to the shared folder, with options of its writer, and reads them back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(shares: list[DataFrame], key: str, name: str) -> DataFrame:
    """As written(), in as many buckets by key as a shuffle has partitions: a join or group by the key moves only the other side's rows. The shares are written one after another, each once the files of the one before are on their way out."""
    spark = shares[0].sparkSession
    path = new_path(spark, name)
    _tables[path] = table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for share in shares:
        collected(spark)
        share.write.mode("append").bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(table, format="parquet")
    return spark.table(table)


def written_alone(df: DataFrame, name: str, **options) -> DataFrame:
    """As written(), compressed well, once the files of earlier tables' shuffles are on their way out: they are most of the disk."""
    collected(df.sparkSession)
    return written(df, name, compression="zstd", **options)


def collected(spark: SparkSession) -> None:
    """Lets the driver notice which shuffles no DataFrame needs any more, so that Spark removes their files; without it they wait for the driver's heap to fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: A number for each row of a stored table, the same whenever the table is read.
ROW = "xxhash64(_metadata.file_path, _metadata.row_index)"


def numbered_rows(docs: DataFrame, stored: bool) -> DataFrame:
    """row, and the columns of docs as d0, d1 ...; if docs isn't a stored table, whose rows keep their places, it is written once."""
    row = F.expr(ROW) if stored else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), *[docs[f"`{c}`"].alias(f"d{i}") for i, c in enumerate(docs.columns)])
    return rows if stored else written_alone(rows, "docs")


def parts(total: float, each: float, least: int = 1) -> int:
    """How many pieces of a size a total needs."""
    return max(least, -(-int(total) // max(1, int(each))))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def numbered(rows: DataFrame, order: list, n: int, name: str) -> DataFrame:
    """rows, dealt out by ranges of the sort keys `order` to n partitions, with part and idx: the partition and the place in it. Written."""
    x = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(x.withColumns({"part": F.spark_partition_id().cast("long"), "idx": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), name)


def pieces(rows: DataFrame, group: str) -> DataFrame:
    """group, part, first (its least idx there), n, before (rows of the group in earlier parts), total, of rows that numbered() has sorted by group first.

    A row for each group and part: nothing here grows with the rows of a group, but with the parts that they fill.
    """
    x = rows.groupBy(group, "part").agg(F.min("idx").alias("first"), F.count("*").alias("n"))
    whole, past = Window.partitionBy(group), Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return x.withColumns({"before": F.coalesce(F.sum("n").over(past), F.lit(0)), "total": F.sum("n").over(whole)})


def crc32_sql(column: str) -> str:
    """DuckDB's text for the unsigned crc32 of an integer column as decimal text, which it has no function for."""
    digits = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: {byte}), 4294967295)"


# ---------------------------------------------------------------- hashing


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64); consumes its argument."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def odd(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers made from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_ODD = odd(4096, 11)
#: A-Z become a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: \x20 and \x09-\x0D
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+`, and how many each text has.

    data: lower-cased bytes of all texts, each followed by one space; starts:
    where each text begins, and the end. A word's hash is the sum of its
    bytes times a multiplier for each place, mixed with its length; the
    multipliers repeat after 4096 bytes with another factor.
    """
    gap = SPACE[data]
    inside = ~gap
    first = np.flatnonzero(inside & np.concatenate(([True], gap[:-1])))
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    last = np.flatnonzero(inside & np.concatenate((gap[1:], [True]))) + 1
    size = last - first
    at = np.flatnonzero(inside)
    before = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(at)) - np.repeat(before, size)
    v = (data[at].astype(np.uint64) + np.uint64(1)) * _ODD[place & 4095]
    if size.max() > 4096:
        far = np.flatnonzero(place >> 12)
        turn = place[far] >> 12
        v[far] *= _ODD[turn & 4095] + np.uint64(2) * turn.astype(np.uint64)
    h = np.add.reduceat(v, before) + size.astype(np.uint64) * _ODD[7]
    return mix(h), np.diff(np.searchsorted(first, starts))


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, each followed by one space, and where each begins."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))).astype(np.int64)
    return LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)], starts


def chunks(texts: list, most: int = 1_000_000):
    """Ranges of rows whose texts have about that many characters together; one longer text is a range of its own."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        k = len(t) if t else 0
        if n and n + k > most:
            yield at, i
            at, n = i, 0
        n += k
    if at < len(texts):
        yield at, len(texts)


def spans(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each count n, one after another."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
