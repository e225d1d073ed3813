"""Parts of a stream in files, and how often a game's state is asked."""

import os
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Row

from cluelake.plans import streams
from cluelake.sources import commit
from cluelake.streaming import live


def test_a_part_of_many_files_is_one_batch(spark, monkeypatch):
    made, scratch = [], commit.scratch
    monkeypatch.setattr(commit, "scratch", lambda s, name: made.append((name, scratch(s, name))) or made[-1][1])
    parts = [spark.range(0, 100, 1, 5), spark.range(200, 201, 1, 1), spark.range(300, 340, 1, 3)]
    rows = streams.ended(streams.in_files(parts, parts[0].schema, "several"), "several-out", "append").collect()
    got = {}
    for r in rows:
        got.setdefault(r.batch, set()).add(r.id)
    assert [got[b] for b in sorted(got)] == [set(range(100)), {200}, set(range(300, 340))]
    folder = dict(made)["several"].removeprefix("file://")
    assert [len([f for f in os.listdir(f"{folder}/{i:03d}") if f.endswith(".parquet")]) for i in range(3)] == [5, 5, 5]


def test_a_game_asks_its_state_a_fixed_number_of_times():
    calls, held = [], []

    class Value:
        def exists(self):
            calls.append("exists")
            return bool(held)

        def get(self):
            calls.append("get")
            return held[-1]

        def update(self, v):
            calls.append("update")
            held.append(v)

    game = live.Replay()
    game.init(SimpleNamespace(getValueState=lambda *a: Value()))
    columns = [c.split()[0] for c in live.EVENTS.split(", ")]
    cast = [{"episode": 1, "kind": "cast", "who": f"P{i}"} for i in range(3)]
    fixes = [{"episode": 1, "kind": "adjustment", "who": "P1", "points": 100 * i, "after": i} for i in range(1, 4)]
    clue = lambda i: {"episode": 1, "kind": "clue", "pos": i, "selection_order": i, "round": "J!", "board_row": 1, "is_dd": False, "speakers": ["P0"], "right": [True]}
    for came in (cast + fixes + [clue(2), clue(1)], [clue(3), {"episode": 1, "kind": "final", "who": "P0", "points": 50, "is_correct": False}]):
        (out,) = game.handleInputRows((1,), iter([pd.DataFrame(came, columns=columns)]), None)
    assert calls == ["exists", "update", "exists", "get", "update"]
    assert {r.who: (r.score, r.adjusted, r.pending, r.clues) for r in out.itertuples()} == {"P0": (550, 0, 0, 3), "P1": (600, 600, 0, 3), "P2": (0, 0, 0, 3)}


def test_episodes_of_a_run_ask_their_state_together():
    calls, held = [], []

    class Value:
        def get(self):
            calls.append("get")
            return held[-1] if held else None

        def update(self, v):
            calls.append("update")
            held.append(v)

    games = live.RunReplay()
    games.init(SimpleNamespace(getValueState=lambda *a: Value()))
    columns = [c.split()[0] for c in live.EVENTS.split(", ")]
    rows = lambda *events: iter([Row(*columns, "run")(*[e.get(c) for c in columns], 0) for e in events])
    cast = [{"episode": e, "kind": "cast", "who": w} for e in range(50) for w in ("A", "B")]
    clue = lambda e, i: {"episode": e, "kind": "clue", "pos": i, "selection_order": i, "round": "J!", "board_row": 1 + e % 5, "is_dd": False, "speakers": ["A"], "right": [True]}
    fix = [{"episode": e, "kind": "adjustment", "who": "B", "points": e, "after": 2} for e in range(0, 50, 2)]
    list(games.handleInputRows((0,), rows(*cast, *fix, *[clue(e, 1) for e in range(50)]), None))
    out = list(games.handleInputRows((0,), rows(*[clue(e, 2) for e in range(0, 50, 2)]), None))
    assert calls == ["get", "update"] * 2
    want = [(e, "A", 400 * (1 + e % 5), 0, 2) for e in range(0, 50, 2)] + [(e, "B", e, e, 2) for e in range(0, 50, 2)]
    assert sorted((r.episode, r.who, r.score, r.adjusted, r.clues) for r in out) == sorted(want)  # only episodes that the batch touches
    assert len(held[-1][0]) == 50


def test_episodes_of_one_run_and_of_others_in_a_stream(spark, tmp_path):
    columns = [c.split()[0] for c in live.EVENTS.split(", ")]
    episodes = [1, 2, live.RUN, 5 * live.RUN + 3]
    cast = [{"episode": e, "kind": "cast", "who": "A"} for e in episodes]
    clues = [{"episode": e, "kind": "clue", "pos": i, "selection_order": i, "round": "J!", "board_row": i, "is_dd": False, "speakers": ["A"], "right": [e % 2 == 1]} for e in episodes for i in (1, 2)]
    parts = [spark.createDataFrame([tuple(x.get(c) for c in columns) for x in xs], live.EVENTS) for xs in (cast + clues[::2], clues[1::2])]
    rows = streams.ended(live.scoreboard(streams.in_files(parts, live.EVENTS, "runs")), "runs-out").collect()
    got = {(r.episode, r.score, r.clues) for r in rows if r.batch == max(x.batch for x in rows)}
    assert got == {(e, 600 if e % 2 else -600, 2) for e in episodes}
