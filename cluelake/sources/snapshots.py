"""A table of Parquet files whose manifests say which of them count: appends, compaction by size, and the removal of files that no manifest names.

A manifest `_manifest/<number>.json` lists the live files with their sizes and
is put there only if its number is free, so that readers see one snapshot or
the next, and of two writers one begins again. Files are written before the
manifest that names them; what a writer that died has left is an orphan.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cluelake.sources.commit import _fs
from cluelake.sources.log import Conflict, put_if_absent

Files = dict[str, int]


def binned(files: Files, target: int) -> list[list[str]]:
    """Files of less than half the target in bins of the target's size at most: the largest first, each in the first bin that has room. Bins of one file are left out."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(files.items(), key=lambda x: (-x[1], x[0])):
        if 2 * size >= target:
            continue
        at = next((i for i, (used, _) in enumerate(bins) if used + size <= target), None)
        if at is None:
            bins.append((size, [name]))
        else:
            bins[at] = (bins[at][0] + size, [*bins[at][1], name])
    return [names for _, names in bins if len(names) > 1]


class SnapshotTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/_manifest/{number:020d}.json"

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.folder}/_manifest")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> tuple[int, Files, dict | None]:
        """(number, live files and their sizes, schema) of a version, the last by default; of none, nothing."""
        found = self.versions()
        if not found:
            return 0, {}, None
        number = found[-1] if version is None else version
        fs, p = _fs(self.spark, self._manifest(number))
        stream = fs.open(p)
        try:
            x = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return number, x["files"], x["schema"]

    def read(self, version: int | None = None) -> DataFrame:
        _, files, schema = self.manifest(version)
        if schema is None:
            raise ValueError(f"{self.folder} has no snapshot")
        kind = T.StructType.fromJson(schema)
        return self.spark.read.schema(kind).parquet(*[f"{self.folder}/{f}" for f in files]) if files else self.spark.createDataFrame([], kind)

    def _written(self, rows: DataFrame) -> Files:
        """Files of rows, which no manifest names yet."""
        path = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{path}")
        fs, p = _fs(self.spark, f"{self.folder}/{path}")
        return {f"{path}/{f.getPath().getName()}": f.getLen() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")}

    def _publish(self, number: int, files: Files, schema: dict) -> bool:
        return put_if_absent(self.spark, self._manifest(number), json.dumps({"files": files, "schema": schema, "at": time.time()}))

    def append(self, rows: DataFrame, tries: int = 50) -> int:
        """Adds rows; the number of the snapshot that has them."""
        new = self._written(rows)
        for _ in range(tries):
            number, files, schema = self.manifest()
            if self._publish(number + 1, files | new, schema or rows.schema.jsonValue()):
                return number + 1
        raise Conflict(self.folder)

    def compact(self, target: int = 128_000_000, tries: int = 50) -> int | None:
        """Rewrites small files, a bin of them as one file, in one Spark job; the new snapshot's number, or None where there is nothing to do.

        Large files stay as they are. Rows that others append meanwhile stay,
        too; where another compaction has rewritten one of the same files, this
        one's work is left as an orphan.
        """
        _, files, schema = self.manifest()
        bins = binned(files, target)
        if not bins:
            return None
        where = self.spark.createDataFrame([(f.rsplit("/", 1)[-1], i) for i, names in enumerate(bins) for f in names], "_file string, _bin int")  # names of small files, each in one bin
        gone = {f for names in bins for f in names}
        rows = self.spark.read.schema(T.StructType.fromJson(schema)).parquet(*[f"{self.folder}/{f}" for f in sorted(gone)])
        names = rows.columns
        rows = rows.withColumn("_file", F.col("_metadata.file_name")).join(F.broadcast(where), "_file").repartitionById(len(bins), F.col("_bin"))
        new = self._written(rows.select(*names))
        for _ in range(tries):
            number, files, schema = self.manifest()
            if not gone <= set(files):
                return None
            if self._publish(number + 1, {f: n for f, n in files.items() if f not in gone} | new, schema):
                return number + 1
        raise Conflict(self.folder)

    def sweep(self, keep: int = 2, older_than_s: float = 7 * 86400) -> list[str]:
        """Marks the files of the last `keep` snapshots and removes all others that are older, and the manifests before those; returns the files.

        The age spares files whose writer hasn't put its manifest yet.
        """
        kept = self.versions()[-keep:]
        live = {f for v in kept for f in self.manifest(v)[1]}
        fs, p = _fs(self.spark, f"{self.folder}/data")
        until, gone = (time.time() - older_than_s) * 1000, []
        for d in fs.listStatus(p) if fs.exists(p) else []:
            inside = [(f"data/{d.getPath().getName()}/{f.getPath().getName()}", f) for f in fs.listStatus(d.getPath())]
            for name, f in inside:
                if name not in live and f.getModificationTime() <= until:
                    fs.delete(f.getPath(), True)
                    if f.getPath().getName().startswith("part-"):
                        gone.append(name)
            if not any(name in live or f.getModificationTime() > until for name, f in inside):
                fs.delete(d.getPath(), True)
        for v in self.versions():
            if kept and v < kept[0]:
                fs.delete(_fs(self.spark, self._manifest(v))[1], False)
        return sorted(gone)
