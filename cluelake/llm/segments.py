"""Documents packed in segments, and questions about hashes that segments ask and buckets answer.

A segment is one row that holds some MB of documents as bytes. Segments are
written once to the shared folder without moving a row between executors, and
several passes can read them in the same cut. A pass that needs to know
something about every hash of a segment (how often it occurs in the corpus,
say) asks: it sorts its distinct hashes and sends to each bucket of the hash
space the part that falls into it. A bucket answers each segment in the order
of its question. So what is moved is each segment's distinct hashes, 6 bytes
each, once; a hash in every document is sent once by a segment, which keeps
frequent ones from meeting in one task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common, tokenfile

pa.set_memory_pool(pa.system_memory_pool())  # gives back what is freed
_libc = ctypes.CDLL(None)
#: Text bytes of a segment; a longer document is a segment of its own.
SEGMENT = 4_000_000
#: Hashes that a bucket answers.
BUCKET = 800_000
#: The top 32 bits of a hash choose the bucket; its low bits are sent.
LOW = 48
_MASK, _HALF = np.uint64((1 << LOW) - 1), np.uint64(32)
#: Segments whose answers one task writes.
ANSWERS = 8


class Segment:
    """Documents of a segment: ids (int64), known (their ids aren't null), extra (int64 for each), texts as bytes with one separator after each."""

    def __init__(self, row: dict):
        self.seg = row["seg"]
        self.ids, self.extra = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["extra"], "<i8")
        self.known = np.frombuffer(row["known"], np.uint8) == 1
        self.starts = np.frombuffer(row["starts"], "<i8")  # and the end of the last, separators included
        self.data = np.frombuffer(row["data"], np.uint8)

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, mask=~self.known)

    def chunks(self, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
        """Ranges of documents of about that many bytes."""
        i, n = 0, len(self.ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + most, "right")) - 1)
            yield i, j
            i = j

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1] - 1].tobytes()

    def part(self, i: int, j: int) -> Segment:
        """The documents from i up to j, without a copy of their texts."""
        out = object.__new__(Segment)
        out.seg, out.ids, out.extra, out.known = self.seg, self.ids[i:j], self.extra[i:j], self.known[i:j]
        out.starts, out.data = self.starts[i : j + 1] - self.starts[i], self.data[self.starts[i] : self.starts[j]]
        return out

    def only(self, which: list[int]) -> Segment:
        """A segment of some of the documents."""
        raw = [self.data[self.starts[i] : self.starts[i + 1]].tobytes() for i in which]
        starts = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype("<i8")
        return Segment({"seg": self.seg, "ids": self.ids[which].tobytes(), "known": self.known[which].tobytes(), "extra": self.extra[which].tobytes(), "starts": starts.tobytes(), "data": b"".join(raw)})


SCHEMA = "seg long, ids binary, known binary, extra binary, starts binary, data binary"


def pack(docs: DataFrame, extra, separator: int = 32) -> DataFrame:
    """Segments of docs (doc_id, text), written to the shared folder; extra: a long column kept for each. Null texts are empty."""
    spark = common.session(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        seg, held, size = TaskContext.get().partitionId() << 32, [], 0
        mark = bytes([separator])

        def flush():
            nonlocal seg, held, size
            raw = [x[2] for x in held]
            starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))).astype("<i8")
            out = {
                "seg": [seg],
                "ids": [np.array([x[0] or 0 for x in held], "<i8").tobytes()],
                "known": [bytes(x[0] is not None for x in held)],
                "extra": [np.array([x[1] for x in held], "<i8").tobytes()],
                "starts": [starts.tobytes()],
                "data": [mark.join(raw) + mark],
            }
            seg, held, size = seg + 1, [], 0
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for d, x, t in zip(*(c.to_pylist() for c in batch.columns)):
                raw = b"" if t is None else t.encode("utf-8", "surrogatepass")
                if held and size + len(raw) > SEGMENT:
                    yield flush()
                held.append((d, x, raw))
                size += len(raw) + 1
        if held:
            yield flush()

    rows = docs.select("doc_id", extra.cast("long").alias("extra"), "text")
    # a row group is held whole where it is written and where it is read; Parquet looks at its bytes after 100 rows only, which are 400 MB here
    out = common.written(rows.mapInArrow(run, SCHEMA), "segments", compression="zstd", **{"parquet.block.row.count.limit": "1"})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row is MBs
    return out


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}


def trim() -> None:
    """Gives freed memory back to the system: workers wait for their next task with what they have once taken."""
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def each(segments: DataFrame, f: Callable[[Segment], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches):
        for row in rows_of(batches):
            yield from f(Segment(row))
            del row
            trim()

    return segments.mapInArrow(run, schema)


def by_bucket(asked: DataFrame, f: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """f of all rows of each bucket."""

    def run(table):
        out = f(table)
        trim()
        return out

    return asked.groupBy("bucket").applyInArrow(run, schema)


def n_buckets(total_bytes: int, bytes_a_hash: float = 6.0) -> int:
    return common.parts(total_bytes / bytes_a_hash, BUCKET)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> _HALF) * np.uint64(n)) >> _HALF


def bucket_edges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where the buckets 0..n-1 begin among sorted hashes, and the end."""
    return np.searchsorted(bucket_of(hashes, n), np.arange(n + 1, dtype=np.uint64))


def send(hashes: np.ndarray) -> bytes:
    """The low bits of hashes of one bucket, 6 bytes each."""
    low = hashes & _MASK
    return low.astype("<u4").tobytes() + (low >> np.uint64(32)).astype("<u2").tobytes()


def receive(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    return np.frombuffer(blob, "<u4", n).astype(np.uint64) | (np.frombuffer(blob, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def distinct(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each occurs."""
    if not len(sorted_):
        return sorted_, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    return sorted_[at], np.diff(np.append(at, len(sorted_)))


def keep_answers(answers: DataFrame, n_segments: int) -> str:
    """Writes answers (seg, bucket, blob ...) with a folder for each segment; returns the path, from which answer() reads."""
    path = common.new_path(answers.sparkSession, "answers")
    answers.repartition(common.parts(n_segments, ANSWERS), F.col("seg")).write.partitionBy("seg").parquet(path)
    return path


def answer(path: str, seg: int) -> dict[int, dict]:
    """What the buckets answered a segment, by bucket."""
    fs, top = tokenfile.filesystem(path)
    out = {}
    try:
        files = fs.get_file_info(tokenfile.pafs.FileSelector(f"{top}/seg={seg}"))
    except FileNotFoundError:
        return out
    for f in files:
        if f.path.endswith(".parquet"):
            with fs.open_input_file(f.path) as source:
                for row in pq.ParquetFile(source).read().to_pylist():
                    out[row["bucket"]] = row
    return out
