"""Operator 2: WARC files, and an audit of replicas by Merkle trees.

Records, as stored, are hashed (leaves), and ordered runs of FAN neighbours, which cover a
range of offsets, are hashed level by level up to one root for each file; the
files' roots are the leaves of the replica's own tree. Two replicas are
compared from their roots down: only children of nodes that differ are looked
at, so an audit of equal replicas reads two rows. Trees are tables in the
shared folder, a partition for each level.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cluelake.llm import common
from cluelake.llm.tokenfile import filesystem

FAN = 16
#: Payload bytes of a file.
FILE_BYTES = 32_000_000
#: Bytes read at a time where a record's end isn't known yet.
HEAD = 16384
#: Of gzip.
LEVEL = 1


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A WARC resource record; nulls are empty."""
    body = (html or "").encode("utf-8", "surrogatepass")
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\nWARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, n_files: int) -> DataFrame:
    """Writes pages (page_id, url, html, flip) as WARC files in ascending page_id; returns file_no, file, n_bytes, flips.

    A record is a gzip member of its own, as WARC files are kept. Null ids come
    first; rows with equal ids follow one another by the hash of url and html,
    so that no page is needed to find the files' bounds. flips: where the
    middle bytes of the stored records with flip stand, for replicate(). A file
    gets its name when it is complete.
    """
    order = [F.col("page_id").asc_nulls_first(), F.col("tie")]
    rows = pages.select("page_id", "url", "html", "flip", F.xxhash64("url", "html").alias("tie")).repartitionByRange(n_files, *order)
    rows = rows.sortWithinPartitions(*order, F.col("url").asc_nulls_first(), F.col("html").asc_nulls_first()).drop("tie")

    def run(batches):
        no, (fs, top), out, size, flips = TaskContext.get().partitionId(), filesystem(folder), None, 0, []
        final, mine = f"{top}/part-{no:06d}.warc.gz", f"{top}/_{no}-{uuid.uuid4().hex}"
        for batch in batches:
            for p, u, h, flip in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs.create_dir(top, recursive=True)
                    out = fs.open_output_stream(mine)
                raw = packed(record(p, u, h))
                out.write(raw)
                if flip:
                    flips.append(size + len(raw) // 2)
                size += len(raw)
        if out is not None:
            out.close()
            fs.move(mine, final)
            yield pa.RecordBatch.from_arrays([pa.array([no]), pa.array([final]), pa.array([size]), pa.array([flips], pa.list_(pa.int64()))], names=["file_no", "file", "n_bytes", "flips"])

    return common.written(rows.mapInArrow(run, "file_no long, file string, n_bytes long, flips array<bigint>"), "warc-files")


def replicate(files: DataFrame, folder: str) -> DataFrame:
    """Copies the files to the folder, with a bit inverted in each byte of flips: damage for tests of the audit; returns file_no, file."""

    def run(batches):
        fs, top = filesystem(folder)
        fs.create_dir(top, recursive=True)
        for batch in batches:
            for no, file, flips in zip(*(c.to_pylist() for c in batch.columns)):
                final, mine, at = f"{top}/{file.rsplit('/', 1)[1]}", f"{top}/_{no}-{uuid.uuid4().hex}", 0
                with fs.open_input_stream(file, compression=None) as source, fs.open_output_stream(mine) as out:
                    while raw := bytearray(source.read(1 << 20)):
                        for x in flips:
                            if at <= x < at + len(raw):
                                raw[x - at] ^= 1
                        out.write(bytes(raw))
                        at += len(raw)
                fs.move(mine, final)
                yield pa.RecordBatch.from_pydict({"file_no": [no], "file": [final]})

    return common.written(files.select("file_no", "file", "flips").repartition(max(1, files.count()), "file_no").mapInArrow(run, "file_no long, file string"), "warc-files")


def packed(raw: bytes) -> bytes:
    """A gzip member; equal for equal bytes."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def records(source: pafs.FileSystem, file: str, index: list[tuple[int, int]] | None = None) -> Iterator[tuple[int, bytes, bytes | None]]:
    """(offset, stored bytes, record) of each gzip member of a WARC stream, one at a time; with an index, at those offsets and lengths, and without the record.

    A stream that can't be unpacked any further ends in one last record, given as it is stored.
    """
    with source.open_input_stream(file, compression=None, buffer_size=1 << 20) as f:
        at = 0
        if index is not None:
            for _, n in index:
                raw = f.read(n)
                if not raw:
                    return
                yield at, raw, None
                at += n
            rest = f.read()
            if rest:
                yield at, rest, None
            return
        held = f.read(HEAD)  # read, but not yet given out
        while held:
            z, read, raw = zlib.decompressobj(31), [held], []
            try:
                raw.append(z.decompress(held))
                while not z.eof:
                    if not (more := f.read(HEAD)):
                        raise zlib.error("cut")
                    read.append(more)
                    raw.append(z.decompress(more))
            except zlib.error:
                stored = b"".join(read) + f.read()
                yield at, stored, stored
                return
            held, stored = z.unused_data, b"".join(read)
            stored = stored[: len(stored) - len(held)]
            yield at, stored, b"".join(raw)
            at += len(stored)
            held = held or f.read(HEAD)


def _page_id(raw: bytes) -> int | None:
    line = next((x for x in raw[:512].split(b"\r\n") if x.startswith(b"WARC-Record-ID: <urn:page:")), b"")
    x = line.split(b"urn:page:")[-1].rstrip(b">")
    return int(x) if x else None


def leaves(files: DataFrame, folder: str, against: DataFrame | None = None) -> DataFrame:
    """file_no, at, start, end, hash of every record of the files as stored; and, where they are parsed, page_id, n_bytes, record_sha256 of the record.

    against: leaves of the first replica, whose ranges the others are hashed in (fixity compares the same ranges).
    """
    if against is None:
        src = files.select("file_no", "file", F.array().cast("array<bigint>").alias("ends"))
    else:
        ends = against.groupBy("file_no").agg(F.sort_array(F.collect_list("end")).alias("ends"))  # a file's records: bounded by FILE_BYTES
        src = files.select("file_no", "file").join(ends, "file_no", "left").select("file_no", "file", F.coalesce("ends", F.array().cast("array<bigint>")).alias("ends"))

    parsed = against is None
    schema = "file_no long, at long, start long, end long, hash string" + (", page_id long, n_bytes long, record_sha256 string" if parsed else "")

    def run(batches):
        fs, _ = filesystem(folder)
        kinds = [pa.string() if x.endswith("string") else pa.int64() for x in schema.split(", ")]
        for batch in batches:
            for no, file, ends in zip(*(c.to_pylist() for c in batch.columns)):
                index = None if parsed else [(a, b - a) for a, b in zip([0, *ends], ends)]
                rows = []
                for i, (a, stored, raw) in enumerate(records(fs, file, index)):
                    row = (no, i, a, a + len(stored), hashlib.sha256(stored).hexdigest())
                    rows.append(row + ((_page_id(raw), len(raw), hashlib.sha256(raw).hexdigest()) if parsed else ()))
                cols = [*zip(*rows)] or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return common.written(src.repartition(max(1, files.count()), "file_no").mapInArrow(run, schema), "warc-leaves")


def _level(nodes: DataFrame) -> DataFrame:
    """Parents: runs of FAN nodes."""
    x = nodes.groupBy("file_no", F.floor(F.col("at") / FAN).alias("up")).agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("c"), F.min("start").alias("start"), F.max("end").alias("end"))
    return x.select("file_no", F.col("up").alias("at"), "start", "end", F.sha2(F.array_join(F.transform("c", lambda n: n["hash"]), ""), 256).alias("hash"))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """Levels from leaves to the replica's root. Files' nodes have file_no >= 0; above them, file_no is -1."""
    levels = [leaf]
    most = leaf.agg(F.max("at")).first()[0] or 0
    while most > 0:
        levels.append(common.written(_level(levels[-1]), "warc-level"))
        most //= FAN
    top = levels[-1].select(F.lit(-1).cast("long").alias("file_no"), F.col("file_no").alias("at"), F.col("file_no").alias("start"), F.col("file_no").alias("end"), "hash")
    levels.append(common.written(top, "warc-roots"))
    most = top.agg(F.max("at")).first()[0] or 0
    while most > 0:
        levels.append(common.written(_level(levels[-1]), "warc-level"))
        most //= FAN
    return levels


def audit(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """file_no, at, start, end, status (changed, missing in b, extra in b) of the leaves that differ.

    Trees of another shape share no inner nodes; then all leaves are compared.
    """
    files = lambda t: sum(d.filter("file_no >= 0").limit(1).count() for d in t)
    if len(a) != len(b) or files(a) != files(b):
        return _diff(a[0], b[0])
    top, front = files(a), None  # level `top` holds the files' roots as leaves of the upper tree
    for i in range(len(a) - 1, -1, -1):
        found = common.written(_diff(a[i], b[i], front), "warc-front")
        if i == 0 or found.isEmpty():
            return found.filter("false") if i else found
        front = found.select(F.col("at").alias("file_no"), F.lit(0).cast("long").alias("up")) if i == top else found.select("file_no", F.col("at").alias("up"))


def _diff(a: DataFrame, b: DataFrame, front: DataFrame | None = None) -> DataFrame:
    """Nodes that differ; with a front, only children of its nodes."""
    if front is not None:
        child = lambda d: d.withColumn("up", F.floor(F.col("at") / FAN)).join(front, ["file_no", "up"], "left_semi").drop("up")
        a, b = child(a), child(b)
    x, y = a.alias("x"), b.alias("y")
    j = x.join(y, (F.col("x.file_no") == F.col("y.file_no")) & (F.col("x.at") == F.col("y.at")), "full_outer")
    j = j.filter(~F.col("x.hash").eqNullSafe(F.col("y.hash")))
    pick = lambda c: F.coalesce(f"x.{c}", f"y.{c}").alias(c)
    status = F.when(F.col("x.hash").isNull(), "extra").when(F.col("y.hash").isNull(), "missing").otherwise("changed")
    return j.select(pick("file_no"), pick("at"), pick("start"), pick("end"), status.alias("status"))


def audited(pages: DataFrame, damaged) -> DataFrame:
    """page_id, n_bytes, record_sha256, corrupt of each row of pages (page_id, url, html).

    Writes two replicas, the second damaged where the condition `damaged`
    holds, hashes both from their files, as stored, and locates the damage by
    descent. A record's own hash and length are told from the first one's files.
    """
    spark = common.session(pages.sparkSession)
    src = pages.select("page_id", "url", "html")
    n = common.parts(src.agg(F.sum(F.octet_length("html"))).first()[0] or 0, FILE_BYTES)
    one, two = common.new_path(spark, "warc-a"), common.new_path(spark, "warc-b")
    files = write(src.withColumn("flip", F.coalesce(damaged, F.lit(False))), one, n)
    common.collected(spark)  # pages as shuffled take more of the disk than a replica
    a = leaves(files, one)
    common.collected(spark)
    b = leaves(replicate(files, two), two, a)
    nodes = a.select("file_no", "at", "start", "end", "hash")
    found = audit(tree(nodes), tree(b)).select("file_no", "at", F.lit(True).alias("corrupt"))
    return a.join(found, ["file_no", "at"], "left").select("page_id", "n_bytes", "record_sha256", F.coalesce("corrupt", F.lit(False)).alias("corrupt"))


SQL = r"""
WITH r AS (SELECT page_id, concat('WARC/1.1', e, 'WARC-Type: resource', e, 'WARC-Record-ID: <urn:page:', page_id, '>', e, 'WARC-Target-URI: ', url, e,
  'Content-Type: text/html', e, 'Content-Length: ', strlen(coalesce(html, '')), e, e, html, e, e) AS x
  FROM pages, (SELECT chr(13) || chr(10) AS e) y)
SELECT page_id, strlen(x)::BIGINT AS n_bytes, sha256(x) AS record_sha256, coalesce(page_id % 101 = 7, false) AS corrupt FROM r
"""
