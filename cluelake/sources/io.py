"""Sources and sinks: tables, transcripts, episodes, file discovery, file streams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cluelake.functions.text import episode_id
from cluelake.schemas import EPISODE, TRANSCRIPT
from cluelake.sources.commit import _fs
from cluelake.streaming.queue import open_for

# Extensions of recordings.
EXTENSIONS = (".mp4", ".ts", ".mkv", ".avi", ".mov", ".webm", ".mpg", ".mpeg", ".flv", ".wmv", ".m2ts", ".vob")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _segments(x: DataFrame, *first) -> DataFrame:
    """pos, speaker, text, start_ms, end_ms, words of the segments s; a missing text is empty, a missing time 0."""
    ms = lambda c: (F.coalesce(c, F.lit(0.0)) * 1000)
    return x.select(*first, F.col("pos").cast("long").alias("pos"), "s.speaker", F.coalesce("s.text", F.lit("")).alias("text"), ms("s.start").alias("start_ms"), ms("s.end").alias("end_ms"), "s.words")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """episode, pos, speaker, text, start_ms, end_ms of gzipped or plain JSON transcripts, one document a file."""
    x = spark.read.schema(TRANSCRIPT).json(path, multiLine=True).select(F.col("_metadata.file_name").alias("f"), F.posexplode_outer("transcript.segments").alias("pos", "s"))
    return _segments(x, episode_id(F.regexp_replace("f", r"\.gz$", "")).alias("episode"))


def read_transcript_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same of transcripts that follow one another as lines; video_filepath instead of episode."""
    x = spark.read.schema(TRANSCRIPT).json(path).select("video_filepath", F.posexplode_outer("transcript.segments").alias("pos", "s"))
    return _segments(x, "video_filepath")


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """episode_id and the EPISODE columns; the id is the file's name episode_<id>.json."""
    x = spark.read.schema(EPISODE).json(path, multiLine=True)
    return x.select(F.regexp_extract("_metadata.file_name", r"^episode_(.*)\.json", 1).alias("episode_id"), "*")


def write_json(df: DataFrame, path: str, gzip: bool = False) -> None:
    w = df.write.mode("overwrite")
    (w.option("compression", "gzip") if gzip else w).json(path)


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """episode_id, path, size of recordings below a folder, at any depth; of a folder that isn't there, none. Contents are not read."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return spark.createDataFrame([], "episode_id string, path string, size long")
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("length").alias("size"))
    x = x.filter(F.lower("path").rlike("(?:" + "|".join(e.replace(".", r"\.") for e in EXTENSIONS) + ")$"))
    top = re.escape(re.sub("^file:/*", "/", folder.rstrip("/")))
    return x.select(episode_id(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^{top}/", "")).alias("episode_id"), "path", "size")


def discovered(files: DataFrame, state: DataFrame, stage: str | None = None) -> DataFrame:
    """files with status (New without a row), retry_count and last_error of state, but for those that have completed the stage."""
    x = files.join(state.select("episode_id", "status", "retry_count", "last_error"), "episode_id", "left").fillna({"status": "New", "retry_count": 0})
    return open_for(x, stage)


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the recordings that appear below a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    x = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(folder)
    return x.filter(F.lower("path").rlike("(?:" + "|".join(e.replace(".", r"\.") for e in EXTENSIONS) + ")$")).select("path", F.col("length").alias("size"))
