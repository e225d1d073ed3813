"""Keyed state of games that go on, across batches and restarts."""

import pytest

from cluelake.sources import commit
from cluelake.streaming import live

COLUMNS = [c.split()[0] for c in live.EVENTS.split(", ")]


def rows(spark, *events):
    return spark.createDataFrame([tuple({"episode": 1, **e}.get(c) for c in COLUMNS) for e in events], live.EVENTS)


def clue(order, row=1, tries=(), rnd="J!", **more):
    return {"kind": "clue", "pos": order, "selection_order": order, "round": rnd, "board_row": row, "is_dd": False, "speakers": [w for w, _ in tries], "right": [r for _, r in tries], **more}


def fix(after, points, who="A", episode=1):
    return {"kind": "adjustment", "who": who, "points": points, "after": after, "episode": episode}


@pytest.fixture
def game(spark, tmp_path):
    """Plays batches one after another, each in a run of its own that goes on from the checkpoint; gives the last table of episode 1."""

    def play(*batches):
        out = f"file://{tmp_path}/out"
        for i, b in enumerate(batches):
            b.coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
            stream = spark.readStream.schema(live.EVENTS).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
            live.run_to_end(live.scoreboard(stream), commit.stream_sink(out, lambda x: {"rows": x}), f"file://{tmp_path}/at")
        got = commit.read_table(spark, out, "rows").filter("episode = 1").collect()
        last = max(r.batch for r in got)
        return {r.who: r for r in got if r.batch == last}

    return play


def test_correction_waits_for_its_clue_and_is_applied_once(spark, game):
    got = game(
        rows(spark, {"kind": "cast", "who": "A"}, fix(3, 400), fix(3, -100)),
        rows(spark, clue(1, 2, [("A", False)]), clue(2, 1, [("A", True)])),
        rows(spark, clue(3, 1), clue(3, 1, pos=4), fix(2, 7000), fix(9, 5000)),
    )
    assert (got["A"].score, got["A"].adjusted, got["A"].coryat, got["A"].pending, got["A"].clues) == (-400 + 200 + 300, 300, -200, 2, 4)


def test_cast_daily_doubles_and_finals(spark, game):
    dd = {"is_dd": True, "wager": "True Daily Double", "wagerer": "A"}
    got = game(
        rows(spark, {"kind": "cast", "who": "A"}, {"kind": "cast", "who": "B"}, clue(1, 5, [("X", True), ("B", True), ("A", True)]), clue(2, 3, [("A", True)], **dd)),
        rows(spark, clue(3, 3, [("A", False)], "Double J!", **dd), clue(4, 1, [("A", True)], is_dd=True, wager="5", wagerer=None), clue(5, 1, [], **dd), clue(6, 1, [("A", True)], is_dd=True, wager="a lot", wagerer="A")),
        rows(spark, {"kind": "final", "who": "A", "points": 300, "is_correct": True}, {"kind": "final", "who": "B", "points": 1, "is_correct": False}, {"kind": "final", "who": "X", "points": 9, "is_correct": True}),
    )
    assert set(got) == {"A", "B"}  # X isn't in the cast; a Daily Double without a wagerer is an ordinary clue, one without attempts nothing
    assert (got["A"].score, got["A"].coryat) == (1000 - 2000 + 200 + 300, 600 - 1200 + 200 + 200)
    assert (got["B"].score, got["B"].coryat) == (999, 1000)


def test_without_a_cast_everyone_plays_and_nulls_do_no_harm(spark, game):
    got = game(rows(spark, clue(1, None, [("A", True)], None), clue(2, 1, [("A", True)]), {"kind": "clue", "pos": 3}, fix(2, 50), {"episode": 2, "kind": "cast", "who": "Z"}))
    assert (got["A"].score, got["A"].clues) == (250, 3)


def test_state_store_setting_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with live.keyed_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
