"""The scoreboard of games that are still going on: clues, corrections and Finals as a stream, keyed by episode."""

from __future__ import annotations

from collections import defaultdict, namedtuple
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cluelake.operators.replay import TRUE_DD

#: What comes in. kind: cast (who), adjustment (who, points, after), clue (the rest, with speakers and right in order of attempts) or final (who, points: the wager, is_correct).
EVENTS = "episode long, kind string, who string, points long, after long, is_correct boolean, pos long, round string, board_row int, is_dd boolean, wager string, wagerer string, selection_order long, speakers array<string>, right array<boolean>"
SCORES = "episode long, who string, score long, coryat long, adjusted long, pending long, clues long"

#: Successive episodes that are a key together.
RUN = 64
#: What is kept of a game.
_GAME = {"clues": "bigint", "cast": "array<string>", "scores": "array<struct<who:string,score:bigint,coryat:bigint,adjusted:bigint>>", "pending": "array<struct<after:bigint,who:string,points:bigint>>"}
_SCORES = [c.split()[0] for c in SCORES.split(", ")]
_Score = Row(*_SCORES)
#: A row of EVENTS; its values are had by name at less cost than a Row's.
_Event = namedtuple("_Event", [c.split()[0] for c in EVENTS.split(", ")])

_FACE = {"J!": 200, "Double J!": 400}
_ORDER = {"cast": 0, "adjustment": 1, "clue": 2, "final": 3}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries with typed state are started within this: they need the state store on disk. The setting is put back."""
    key, new = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    old = spark.conf.get(key, None)
    spark.conf.set(key, new)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _some(v) -> bool:
    """Not null; pandas has several nulls."""
    return v is not None and v == v and v is not pd.NA


class Replay(StatefulProcessor):
    """Scores of an episode's players, the corrections that wait for their clue, and how many clues have been played.

    A correction is buffered as it comes and is released by the clue whose
    selection order is exactly the one it is anchored to. One that comes after
    that clue is never applied, and neither is one whose clue never comes: both
    stay pending. A batch's rows are taken as cast, corrections, clues in their
    order, Finals. Once a cast is known, others don't score on standard clues.
    State is as large as an episode, and goes ttl_ms after it was last written.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        # one value: each access to state is a call to the JVM
        self.game = handle.getValueState("game", ", ".join(f"{n} {kind}" for n, kind in _GAME.items()), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        game, scores = self._played(self.game.get() if self.game.exists() else None, (r for x in rows for r in x.itertuples()))
        self.game.update(game)
        yield pd.DataFrame([(key[0], *v) for v in scores], columns=_SCORES)

    def _played(self, held: tuple | None, rows: Iterable) -> tuple[tuple, list[tuple]]:
        """The state of a game, and its SCORES without the episode, after the rows of a batch, where it was held before."""
        clues, cast, scores, waiting = held or (0, [], [], [])
        table = {s[0]: list(s[1:]) for s in scores}
        pending = [tuple(p) for p in waiting]
        known = set(cast)
        came = sorted(rows, key=lambda r: (_ORDER[r.kind], r.pos if _some(r.pos) else float("inf")))
        for r in came:
            if r.kind == "cast":
                known.add(r.who)
                table.setdefault(r.who, [0, 0, 0])
            elif r.kind == "adjustment":
                pending.append((int(r.after), r.who, int(r.points)))
            elif r.kind == "clue":
                clues += 1
                self._clue(r, table, known)
                for after, who, points in pending:
                    if after == r.selection_order:
                        table.setdefault(who, [0, 0, 0])
                        table[who][0] += points
                        table[who][2] += points
                pending = [p for p in pending if p[0] != r.selection_order]
            elif not known or r.who in known:
                table.setdefault(r.who, [0, 0, 0])[0] += int(r.points) if r.is_correct else -int(r.points)
        game = clues, sorted(known), [(who, *v) for who, v in table.items()], pending
        return game, [(who, *v, len(pending), clues) for who, v in table.items() if not known or who in known]

    def _clue(self, r, table: dict[str, list[int]], known: set[str]) -> None:
        face = _FACE.get(r.round, 0) * int(r.board_row) if _some(r.board_row) else 0
        attempts = list(zip(r.speakers if r.speakers is not None else [], r.right if r.right is not None else []))
        if r.is_dd is True and _some(r.wager) and r.wagerer:
            if not attempts:
                return
            mine = table.setdefault(r.wagerer, [0, 0, 0])
            try:
                stake = max(mine[0], 2000 if r.round == "Double J!" else 1000) if r.wager == TRUE_DD else int(r.wager)
            except ValueError:
                stake = 0
            sign = 1 if attempts[0][1] else -1
            mine[0] += sign * stake
            mine[1] += sign * face
            return
        for who, right in attempts:
            if known and who not in known:
                continue
            mine = table.setdefault(who, [0, 0, 0])
            mine[0] += face if right else -face
            mine[1] += face if right else -face
            if right:
                return

    def close(self) -> None:
        pass


class RunReplay(Replay):
    """Replay of a run of episodes, which are a key together; takes and gives rows.

    A key costs some milliseconds for the calls to its state, and as pandas
    frames more than its few rows do. State is as large as the episodes of a run.
    """

    def init(self, handle) -> None:
        self.games = handle.getValueState("games", f"games array<struct<episode:bigint,{','.join(f'{n}:{kind}' for n, kind in _GAME.items())}>>", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.games.get()  # None without a state
        games = {g[0]: tuple(g[1:]) for g in held[0]} if held else {}
        came = defaultdict(list)
        for r in rows:
            came[r[0]].append(_Event._make(r[: len(_Event._fields)]))
        for episode, events in came.items():
            games[episode], scores = self._played(games.get(episode), events)
            for v in scores:
                yield _Score(episode, *v)
        self.games.update(([(episode, *game) for episode, game in games.items()],))


def scoreboard(events: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """SCORES of the episodes that a batch of EVENTS touches, for the update mode. pending: corrections that wait or came too late."""
    mode = "None" if ttl_ms is None else "ProcessingTime"
    run = F.expr(f"episode div {RUN if ttl_ms is None else 1}")  # with a time to live, each episode has its own
    return events.select(*_Event._fields, run.alias("run")).groupBy("run").transformWithState(RunReplay(ttl_ms), SCORES, "update", mode)


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update"):
    """Takes all there is, a batch at a time, and ends; returns the query, whose progress tells about its state."""
    with keyed_state(stream.sparkSession):
        q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    return q
