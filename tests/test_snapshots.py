"""Compaction and clean-up of a table of files: both snapshots read, live files stay, a crash leaves orphans only."""

import os

import pytest

from cluelake.sources import snapshots


@pytest.fixture
def table(spark, tmp_path):
    t = snapshots.SnapshotTable(spark, f"file://{tmp_path}")
    for i in range(6):
        t.append(spark.range(i * 100, i * 100 + 100).selectExpr("id", f"{i} AS lot").coalesce(1))
    return t


def total(df):
    return tuple(df.selectExpr("count(*)", "sum(id)", "count(DISTINCT id)").first())


def on_disk(tmp_path):
    return sorted(f"data/{d.name}/{f.name}" for d in (tmp_path / "data").iterdir() for f in d.iterdir() if f.name.startswith("part-"))


def test_bins():
    assert snapshots.binned({"a": 60, "b": 40, "c": 30, "d": 25, "e": 10, "f": 49}, 100) == [["f", "b", "e"], ["c", "d"]]
    assert snapshots.binned({"a": 10}, 100) == [] and snapshots.binned({}, 100) == []
    many = {f"f{i}": 1 + i * 7 % 40 for i in range(200)}
    bins = snapshots.binned(many, 100)
    assert all(sum(many[f] for f in b) <= 100 for b in bins) and len({f for b in bins for f in b}) == sum(map(len, bins))


def test_compaction_swaps_snapshots(spark, table, tmp_path):
    before = table.versions()[-1]
    size = max(table.manifest()[1].values())
    after = table.compact(target=3 * size + 10)
    assert after == before + 1
    assert len(table.manifest(before)[1]) == 6 and len(table.manifest(after)[1]) == 2
    assert total(table.read(before)) == total(table.read(after)) == (600, sum(range(600)), 600)
    assert table.compact(target=100) is None  # only large files
    assert table.sweep(keep=2, older_than_s=0) == []  # both are still read
    gone = table.sweep(keep=1, older_than_s=0)
    assert len(gone) == 6 and on_disk(tmp_path) == sorted(table.manifest()[1])
    assert total(table.read()) == (600, sum(range(600)), 600) and table.versions() == [after]


def test_crash_between_files_and_manifest(spark, table, tmp_path, monkeypatch):
    live, rows = set(table.manifest()[1]), total(table.read())

    def died(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(table, "_publish", died)
        for work in (lambda: table.append(spark.range(5).selectExpr("id", "9 AS lot")), lambda: table.compact(10**6)):
            with pytest.raises(KeyboardInterrupt):
                work()
    assert total(table.read()) == rows and set(table.manifest()[1]) == live
    lost = set(on_disk(tmp_path)) - live
    assert lost and table.sweep(older_than_s=3600) == []  # too young to be told from a writer at work
    assert set(table.sweep(keep=9, older_than_s=0)) == lost
    assert set(on_disk(tmp_path)) == live and total(table.read()) == rows


def test_append_during_compaction_stays(spark, table, monkeypatch):
    publish, calls = table._publish, []

    def slow(number, files, schema):
        if not calls:
            calls.append(1)
            snapshots.SnapshotTable(spark, table.folder).append(spark.range(600, 650).selectExpr("id", "6 AS lot"))
        return publish(number, files, schema)

    monkeypatch.setattr(table, "_publish", slow)
    assert table.compact(10**6) is not None
    assert total(table.read()) == (650, sum(range(650)), 650)


def test_two_compactions(spark, table, monkeypatch):
    publish, calls = table._publish, []

    def slow(number, files, schema):
        if not calls:
            calls.append(1)
            snapshots.SnapshotTable(spark, table.folder).compact(10**6)
        return publish(number, files, schema)

    monkeypatch.setattr(table, "_publish", slow)
    assert table.compact(10**6) is None  # the other one's files stand
    assert total(table.read()) == (600, sum(range(600)), 600)
    assert len(table.sweep(keep=1, older_than_s=0)) >= 7 and total(table.read())[0] == 600


def test_empty(spark, tmp_path):
    t = snapshots.SnapshotTable(spark, f"file://{tmp_path}")
    with pytest.raises(ValueError):
        t.read()
    assert t.compact() is None and t.sweep() == []
    t.append(spark.range(0).selectExpr("id", "0 AS lot"))
    assert t.read().count() == 0 and os.path.isdir(tmp_path / "data")
