"""Operator 1: token ids as independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, one for each document, then a skippable
zstandard frame that holds the seek table, so any zstandard reader can unpack
the whole file, and a reader that wants some documents reads the table and
only their frames. A frame holds the document's ids as little-endian unsigned
32-bit integers. The table has an entry for each frame:

    doc_id int64, known uint32 (0: the id is null), n_ids uint32,
    offset uint64, stored uint32 (bytes of the frame), crc32 uint32 (of the ids)

and ends in n_frames uint64, n_ids uint64, crc32 of the entries uint32, MAGIC.
Files follow one another in ascending doc_id (null ids first). Each is written
under a name of its task attempt and renamed when complete, so a lost executor
leaves no half-written file under a final name, and a second attempt replaces
the first by the same bytes.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cluelake.llm import common
from cluelake.llm.countfast import byte_letters
from cluelake.llm.pretokens import Memo

MAGIC = b"TKF1"
SKIPPABLE = 0x184D2A5E
ENTRY = np.dtype([("doc_id", "<i8"), ("known", "<u4"), ("n_ids", "<u4"), ("offset", "<u8"), ("stored", "<u4"), ("crc32", "<u4")])
TAIL = struct.Struct("<QQI4s")
#: Text bytes behind a file; documents of a file are ordered in one task.
FILE_BYTES = 24_000_000
#: Files whose sums one task carries.
RUN = 1000


class Corrupt(ValueError):
    """A frame or table whose checksum differs."""


class Writer:
    """Writes frames to a binary stream."""

    def __init__(self, out, level: int = 1):
        self.out, self.at, self.entries, self.n_ids = out, 0, [], 0
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.pack(ids)
        self.out.write(frame)
        self.entries.append((doc_id or 0, doc_id is not None, len(ids) // 4, self.at, len(frame), zlib.crc32(ids)))
        self.at += len(frame)
        self.n_ids += len(ids) // 4

    def close(self) -> None:
        table = np.array(self.entries, ENTRY).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + TAIL.size))
        self.out.write(table + TAIL.pack(len(self.entries), self.n_ids, zlib.crc32(table), MAGIC))


class Reader:
    """Reads documents from a seekable binary stream of a given size."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - TAIL.size)
        n, self.n_ids, crc, magic = TAIL.unpack(source.read(TAIL.size))
        if magic != MAGIC:
            raise Corrupt("no seek table")
        source.seek(size - TAIL.size - n * ENTRY.itemsize)
        raw = source.read(n * ENTRY.itemsize)
        if zlib.crc32(raw) != crc:
            raise Corrupt("seek table")
        self.table = np.frombuffer(raw, ENTRY)
        self.unpack = zstandard.ZstdDecompressor().decompress

    def ids(self, k: int) -> bytes:
        """The ids of frame k, after a check of its checksum; nothing else is read or unpacked."""
        e = self.table[k]
        self.source.seek(int(e["offset"]))
        try:
            ids = self.unpack(self.source.read(int(e["stored"])), max_output_size=int(e["n_ids"]) * 4)
        except zstandard.ZstdError as x:
            raise Corrupt(f"frame {k}: {x}") from x
        if zlib.crc32(ids) != e["crc32"]:
            raise Corrupt(f"frame {k}")
        return ids

    def find(self, doc_id: int) -> list[int]:
        """The frames of a document."""
        return np.flatnonzero((self.table["doc_id"] == doc_id) & (self.table["known"] == 1)).tolist()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI of the shared folder (file, hdfs, s3, gs) or of a plain path."""
    return (pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path))


_encoders: dict[str, object] = {}


def encoder(path: str, pattern: str):
    """texts -> packed ids by the tokenizers library, once for each Python worker.

    With a byte-level pattern, pieces that the library has encoded already are
    remembered; a text that holds the string of an added token goes to the library whole.
    """
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        added = [t.content for t in tok.get_added_tokens_decoder().values()]
        library = lambda texts: [np.array(x.ids, "<u4").tobytes() for x in tok.encode_batch(texts, add_special_tokens=False)]
        memo = Memo(pattern, _pre_tokens(tok, path) or library) if pattern else None

        def run(texts: list[str]) -> list[bytes]:
            if memo is None:
                return library(texts)
            out = memo.values(texts)
            for i, t in enumerate(texts):
                if any(a in t for a in added):
                    out[i] = library([t])[0]
            return out

        _encoders[path] = run
    return _encoders[path]


def _pre_tokens(tok, path: str):
    """Pre-tokens -> packed ids by the library's own model, without its bookkeeping of offsets; None where the file isn't plain byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    letters, run = {b: c for c, b in byte_letters().items()}, tok.model.tokenize
    return lambda new: [array("I", [t.id for t in run(x.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters))]).tobytes() for x in new]


def write(docs: DataFrame, folder: str, path: str, pattern: str | None, end_id: int, n_files: int) -> DataFrame:
    """Writes the ids of every whole text, end_id appended, to files below folder; returns file_no, file, n_docs, n_ids, n_bytes.

    Null texts are empty; null ids come first; rows with equal ids follow one
    another by the hash of their text, so that no text is needed to find the
    files' bounds. An empty table makes no file. Other columns are left out. A
    very long text is encoded in one piece.
    """
    spark = common.session(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(n_files, *order)
    rows = rows.sortWithinPartitions(*order, F.col("text").asc_nulls_first()).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, out = encoder(path, pattern or ""), struct.pack("<I", end_id), None
        no = TaskContext.get().partitionId()
        fs, top = filesystem(folder)
        final, mine = f"{top}/tokens-{no:06d}.tkf", f"{top}/_{no}-{uuid.uuid4().hex}"
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i, j in common.chunks(texts):
                packed = encode(["" if t is None else t for t in texts[i:j]])
                if out is None:
                    fs.create_dir(top, recursive=True)
                    stream = fs.open_output_stream(mine)
                    out = Writer(stream)
                for d, p in zip(ids[i:j], packed):
                    out.add(d, p + end)
        if out is not None:
            out.close()
            stream.close()
            size = fs.get_file_info(mine).size
            fs.move(mine, final)
            yield pa.RecordBatch.from_pydict({"file_no": [no], "file": [final], "n_docs": [len(out.entries)], "n_ids": [out.n_ids], "n_bytes": [size]})

    return common.written(rows.mapInArrow(run, "file_no long, file string, n_docs long, n_ids long, n_bytes long"), "token-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, file_no, frame, offset_ids (ids of the file before it), ids (binary) of every document, from the files."""
    return _scan(manifest, folder, "doc_id long, file_no long, frame long, before long, ids binary", lambda ids: ids, pa.binary())


def _scan(manifest: DataFrame, folder: str, schema: str, value, kind) -> DataFrame:
    def run(batches):
        fs, _ = filesystem(folder)
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            for no, file, size in zip(*(batch.column(c).to_pylist() for c in ("file_no", "file", "n_bytes"))):
                with fs.open_input_file(file) as source:
                    r = Reader(source, size)
                    t = r.table
                    before = np.concatenate(([0], np.cumsum(t["n_ids"], dtype=np.int64)[:-1]))
                    for a in range(0, len(t), 512):
                        e, k = t[a : a + 512], range(a, min(a + 512, len(t)))
                        got = [value(r.ids(i)) for i in k]
                        yield pa.RecordBatch.from_arrays([pa.array(e["doc_id"], mask=e["known"] == 0), pa.array([no] * len(e), pa.int64()), pa.array(k, pa.int64()), pa.array(before[a : a + 512]), pa.array(got, kind), *([pa.array(e["n_ids"].astype(np.int64))] if "n_tokens" in names else [])], names=names)

    n = max(1, manifest.count())
    return manifest.select("file_no", "file", "n_bytes").repartition(n, "file_no").mapInArrow(run, schema)


def _starts(manifest: DataFrame) -> DataFrame:
    """file_no, file_start: the ids in all files before each. Sums are carried over runs of RUN files, so that no task gets a row for every file."""
    files = manifest.select("file_no", "n_ids", F.floor(F.col("file_no") / RUN).alias("run"))
    runs = files.groupBy("run").agg(F.sum("n_ids").alias("k"))
    runs = runs.select("run", (F.sum("k").over(Window.orderBy("run")) - F.col("k")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("run").orderBy("file_no")) - F.col("n_ids")
    return files.withColumn("inside", inside).join(runs, "run").select("file_no", (F.col("before") + F.col("inside")).alias("file_start"))


def digest(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files."""
    rows = _scan(manifest, folder, "doc_id long, file_no long, frame long, before long, ids_crc32 long, n_tokens long", zlib.crc32, pa.int64())
    return rows.join(_starts(manifest), "file_no").select("doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, pattern: str | None, end_id: int) -> DataFrame:
    """Writes the token files of docs below the shared folder and returns their digest, read back from them."""
    spark: SparkSession = docs.sparkSession
    folder = common.new_path(spark, "tokens")
    manifest = write(docs, folder, path, pattern, end_id, common.parts(common.text_bytes(docs), FILE_BYTES))
    return digest(manifest, folder)
