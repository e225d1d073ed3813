"""Data sources over folders of whole files: transcripts, a gzipped or plain JSON document a file, and recordings.

    documents.register(spark)
    spark.read.format("transcripts").load(folder)
    spark.readStream.format("transcripts").load(folder)
    documents.write_transcripts(rows, folder)

Files are listed once on the driver (names, sizes, times) and dealt to tasks by
their sizes; each task opens its own. A folder that isn't there has no files.
As a stream, a source's offset is the time and name of the last file that has
been taken, so that after a restart only newer files come. Files younger than
settleMs wait for the next look, as others may get the same time. One that
appears with an older time than a file that has been taken is not seen; move
files in with a new time. A folder that loses its latest files and gets them
back after a restart may have them taken again.
"""

from __future__ import annotations

import gzip
import json
import os
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from cluelake.sources.io import EXTENSIONS

SEGMENTS = "episode string, pos long, speaker string, text string, start_ms double, end_ms double"
RECORDINGS = "episode string, path string, size long"
#: Bytes of files that a task reads, as they are on disk; and what it costs to open one.
TASK_BYTES, OPEN_BYTES = 32_000_000, 1_000_000


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), os.path.abspath(path))


def listed(path: str, endings: tuple[str, ...]) -> list[tuple[int, str, int]]:
    """(time in ns, path, size) of the files below a folder with these endings, the oldest first. Names that begin with _ or . are left out."""
    fs, top = opened(path)
    found = fs.get_file_info(pafs.FileSelector(top, recursive=True, allow_not_found=True))
    whole = lambda f: f.is_file and f.base_name.lower().endswith(endings) and f.base_name[0] not in "._"
    return sorted((f.mtime_ns or 0, f.path, f.size) for f in found if whole(f))


class Files(InputPartition):
    def __init__(self, folder: str, files: list[tuple[str, int]]):
        self.folder, self.files = folder, files


def dealt(folder: str, files: list[tuple[int, str, int]]) -> list[InputPartition]:
    """Files in partitions of about TASK_BYTES; a larger file is one of its own."""
    out, held, size = [], [], 0
    for _, path, n in files:
        if held and size + n + OPEN_BYTES > TASK_BYTES:
            out.append(Files(folder, held))
            held, size = [], 0
        held.append((path, n))
        size += n + OPEN_BYTES
    return [*out, Files(folder, held)] if held else out


def stem(path: str) -> str:
    """A file's name without its ending, and without .gz."""
    name = path.rsplit("/", 1)[-1]
    return os.path.splitext(name[:-3] if name.lower().endswith(".gz") else name)[0]


def document(fs: pafs.FileSystem, path: str) -> object:
    with fs.open_input_stream(path, compression=None) as f:
        raw = f.read()
    return json.loads(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


class _Transcripts:
    endings, schema = (".json", ".json.gz"), SEGMENTS

    def rows(self, part: Files, options: dict) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(part.folder)
        for path, _ in part.files:
            try:
                whole = document(fs, path)
                found = ((whole if isinstance(whole, dict) else {}).get("transcript") or {}).get("segments") or []
                ms = lambda v: float(v or 0) * 1000
                rows = [(stem(path), i, s.get("speaker"), s.get("text") or "", ms(s.get("start")), ms(s.get("end"))) for i, s in enumerate(found)]
            except (ValueError, AttributeError, TypeError, EOFError, OSError) as e:
                if options.get("badfiles", "fail") == "skip" and not isinstance(e, FileNotFoundError):
                    continue
                raise ValueError(f"{path}: {e}") from e
            yield _batch(rows, SEGMENTS)


class _Recordings:
    endings, schema = EXTENSIONS, RECORDINGS

    def rows(self, part: Files, options: dict) -> Iterator[pa.RecordBatch]:
        yield _batch([(stem(p), p, n) for p, n in part.files], RECORDINGS)


class _Reader(DataSourceReader):
    def __init__(self, kind, options: dict):
        self.kind, self.options = kind, dict(options)

    def partitions(self) -> list[InputPartition]:
        return dealt(self.options["path"], listed(self.options["path"], self.kind.endings)) or [Files(self.options["path"], [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.kind.rows(partition, self.options)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, kind, options: dict):
        self.kind, self.options = kind, dict(options)

    def _files(self) -> list[tuple[int, str, int]]:
        return listed(self.options["path"], self.kind.endings)

    def initialOffset(self) -> dict:
        return {"at": -1, "path": ""}

    def latestOffset(self) -> dict:
        """The last file that is old enough; what was taken stays taken, whatever becomes of the folder."""
        until = time.time_ns() - int(float(self.options.get("settlems", 1000)) * 1e6)
        last = max(((t, p) for t, p, _ in self._files() if t <= until), default=(-1, ""))
        self.last = max(last, getattr(self, "last", (-1, "")))
        return {"at": self.last[0], "path": self.last[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = (start["at"], start["path"]), (end["at"], end["path"])
        return dealt(self.options["path"], [f for f in self._files() if lo < f[:2] <= hi])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.kind.rows(partition, self.options)

    def commit(self, end: dict) -> None:
        pass


class TranscriptSource(DataSource):
    """SEGMENTS of every transcript; the episode is the file's name. Options: badFiles = skip leaves out files that can't be read; settleMs."""

    kind = _Transcripts

    @classmethod
    def name(cls) -> str:
        return "transcripts"

    def schema(self) -> str:
        return self.kind.schema

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.kind(), self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.kind(), self.options)


class RecordingSource(TranscriptSource):
    """RECORDINGS below a folder, without their contents."""

    kind = _Recordings

    @classmethod
    def name(cls) -> str:
        return "recordings"


def register(spark: SparkSession) -> None:
    for source in (TranscriptSource, RecordingSource):
        spark.dataSource.register(source)


def write_transcripts(rows: DataFrame, folder: str) -> DataFrame:
    """Writes each row (episode, document: JSON) to <episode>.json.gz, whole or not at all; gives episode and bytes. To be used once, as each use writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = opened(folder)
        fs.create_dir(top, recursive=True)
        for b in batches:
            out = []
            for episode, text in zip(b.column("episode").to_pylist(), b.column("document").to_pylist()):
                raw = gzip.compress(text.encode(), mtime=0)
                mine = f"{top}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(mine, compression=None) as f:
                    f.write(raw)
                fs.move(mine, f"{top}/{episode}.json.gz")  # a second attempt replaces the first one's file by the same
                out.append((episode, len(raw)))
            yield _batch(out, "episode string, bytes long")

    return rows.select("episode", "document").mapInArrow(run, "episode string, bytes long")
