"""Whole-file sources: batch, stream with restarts, bad and missing files."""

import gzip
import json
import os

import pytest

from cluelake.sources import commit, documents


@pytest.fixture(autouse=True)
def registered(spark):
    documents.register(spark)


def transcript(*texts):
    return json.dumps({"transcript": {"segments": [{"speaker": f"S{i}", "text": t, "start": i, "end": i + 0.5} for i, t in enumerate(texts)]}})


def put(path, text, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if path.suffix == ".gz" else text.encode())
    if at is not None:
        os.utime(path, (at, at))


def segments(df):
    return sorted((r.episode, r.pos, r.text) for r in df.collect())


def test_batch(spark, tmp_path):
    put(tmp_path / "a.json.gz", transcript("x", "y é"))
    put(tmp_path / "deep" / "b.json", transcript("z"))
    put(tmp_path / "empty.json", "{}")
    put(tmp_path / "_part.json", "not whole")
    put(tmp_path / "other.txt", "nothing")
    put(tmp_path / "n.json", json.dumps({"transcript": {"segments": [{}]}}))
    df = spark.read.format("transcripts").load(f"file://{tmp_path}")
    assert segments(df) == [("a", 0, "x"), ("a", 1, "y é"), ("b", 0, "z"), ("n", 0, "")]
    r = df.filter("episode = 'a' AND pos = 1").first()
    assert (r.speaker, r.start_ms, r.end_ms) == ("S1", 1000.0, 1500.0)
    assert segments(spark.read.format("transcripts").load(str(tmp_path / "deep"))) == [("b", 0, "z")]
    assert segments(spark.read.format("transcripts").load(f"file://{tmp_path}/missing")) == []


def test_bad_files(spark, tmp_path):
    put(tmp_path / "a.json", transcript("x"))
    put(tmp_path / "bad.json", '{"transcript": {"segm')
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(transcript("y" * 500).encode())[:40])
    with pytest.raises(Exception, match="bad.json|cut.json"):
        spark.read.format("transcripts").load(str(tmp_path)).collect()
    assert segments(spark.read.format("transcripts").option("badFiles", "skip").load(str(tmp_path))) == [("a", 0, "x")]


def test_files_are_dealt_by_size(monkeypatch):
    monkeypatch.setattr(documents, "TASK_BYTES", 100)
    monkeypatch.setattr(documents, "OPEN_BYTES", 10)
    parts = documents.dealt("d", [(i, f"f{i}", n) for i, n in enumerate([20, 20, 500, 1, 1, 1, 60])])
    assert [[n for _, n in p.files] for p in parts] == [[20, 20], [500], [1, 1, 1], [60]]


def test_stream_takes_new_files_only(spark, tmp_path):
    src, out = tmp_path / "in", f"file://{tmp_path}/out"

    def run():
        stream = spark.readStream.format("transcripts").option("settleMs", 0).load(f"file://{src}")
        q = stream.writeStream.foreachBatch(commit.stream_sink(out, lambda x: {"rows": x})).option("checkpointLocation", f"file://{tmp_path}/at").trigger(availableNow=True).start()
        q.awaitTermination()

    run()  # the folder isn't there yet
    put(src / "a.json", transcript("1"), 1000)
    put(src / "b.json.gz", transcript("2"), 1001)
    run()
    run()
    put(src / "more" / "c.json", transcript("3"), 1001)  # of the same time as the last, but later by name
    put(src / "d.json", transcript("4"), 2000)
    run()
    rows = commit.read_table(spark, out, "rows")
    assert segments(rows) == [("a", 0, "1"), ("b", 0, "2"), ("c", 0, "3"), ("d", 0, "4")]
    assert rows.select("batch").distinct().count() == 2


def test_recordings(spark, tmp_path):
    put(tmp_path / "S01" / "one.MKV", "12345")
    put(tmp_path / "notes.txt", "x")
    put(tmp_path / "two.mp4", "")
    assert sorted((r.episode, r.size) for r in spark.read.format("recordings").load(str(tmp_path)).collect()) == [("one", 5), ("two", 0)]


def test_write_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("e1", transcript("a", "b")), ("e2", transcript())], "episode string, document string")
    for _ in range(2):  # written again, it is the same
        assert sorted(r.episode for r in documents.write_transcripts(rows, f"file://{tmp_path}/out").collect()) == ["e1", "e2"]
    assert sorted(os.listdir(tmp_path / "out")) == ["e1.json.gz", "e2.json.gz"]
    assert segments(spark.read.format("transcripts").load(f"file://{tmp_path}/out")) == [("e1", 0, "a"), ("e1", 1, "b")]


def test_scan_of_a_missing_folder(spark, tmp_path):
    from cluelake.sources import io

    assert io.scan_files(spark, f"file://{tmp_path}/nothing").count() == 0
