"""Known values of the text, board, name and replay operators."""

import pytest
from pyspark.sql import functions as F

from cluelake.functions import board, recover, text, vector
from cluelake.operators import names, ordered, replay, tables
from cluelake.schemas import EPISODE
from cluelake.sources import io
from cluelake.streaming import queue


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'array<double>' if isinstance(v, list) else 'int'}" for i, v in enumerate(values)))
    return df.select(f(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize("a,q", [("Paris", "What is Paris?"), ("the Nile", "What is the Nile?"), ("the Beatles", "Who are the Beatles?"), ("electrons", "What are electrons?"), ("grass", "What is grass?"), ("Paris?", "What is Paris?"), ("What's a sink?", "What's a sink?"), (" ", " ")])
def test_question_form(spark, a, q):
    assert one(spark, text.question_form, a) == q


@pytest.mark.parametrize("t,v", [("I'll take that for $800", 800), ("a wager of $1,000", None), ("score is $800", None), ("She now has $600", None), ("for $3,000", None), ("for $3,400 if you're right", None), ("in 1973 it", None), ("trees for 600", 600), ("$1,200 please", 1200)])
def test_dollar_value(spark, t, v):
    assert one(spark, text.dollar_value, t) == v


@pytest.mark.parametrize("t,n", [("cat", 1), ("hello", 2), ("beautiful", 3), ("make", 1), ("computer", 3), ("", 1), ("nth", 1)])
def test_syllables(spark, t, n):
    assert one(spark, text.syllables, t) == n


def test_preamble(spark):
    f = text.without_preamble
    assert one(spark, f, "I can adapt for $200. This semi-aquatic mammal", "I can adapt") == "This semi-aquatic mammal"
    assert one(spark, f, "History for 600. Short.", "History") == "History for 600. Short."


def test_rows_and_formats(spark):
    f = lambda v, r, b: board.row_of(v, r, b)
    assert [one(spark, f, *x) for x in ((800, "J!", 1), (800, "Double J!", 1), (700, "J!", 1), (5000, "J!", 9), (100, "Final J!", 4))] == [4, 2, 3, 5, 1]
    assert one(spark, board.board_format, "for $100 and $300" + "x" * 60) == "classic"


def test_cosine(spark):
    f = lambda a, b: vector.cosine_distance(a, b)
    assert [one(spark, f, *x) for x in (([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]))] == [0.0, 1.0, 1.0, 1.0]
    with pytest.raises(Exception, match="different length"):
        one(spark, f, [1.0], [1.0, 2.0])


def test_json_and_maps():
    assert recover.speaker_map('{"speakers": {"SPEAKER_00": "Ann"}}') == {"SPEAKER_00": "Ann"}
    assert recover.speaker_map("{'SPEAKER_01': 'Bo'}") == {"SPEAKER_01": "Bo"}
    assert recover.speaker_map('[{"speaker": "SPEAKER_02", "name": "Cy"}]') == {"SPEAKER_02": "Cy"}
    assert recover.speaker_map("I think SPEAKER_03: Dee.\n") == {"SPEAKER_03": "Dee"}


def game(spark, clues, attempts, adjustments=(), finals=()):
    c = spark.createDataFrame(clues, "pos int, round string, board_row int, is_dd boolean, wager string, wagerer string").withColumns({"episode": F.lit("e"), "selection_order": F.col("pos")})
    a = spark.createDataFrame(attempts, "pos int, k int, speaker string, is_correct boolean").withColumn("episode", F.lit("e"))
    p = spark.createDataFrame([("e", x) for x in ("Alice", "Bob", "Charlie")], "episode string, who string")
    j = spark.createDataFrame(list(adjustments), "who string, points int, after int").withColumn("episode", F.lit("e"))
    f = spark.createDataFrame(list(finals), "who string, wager int, is_correct boolean").withColumn("episode", F.lit("e"))
    ev = replay.events(c, a, p, j, f)
    return {r.who: (r.final_score, r.coryat) for r in replay.scores(ev, p).collect()}


def dd(score, wager, right, round_="J!"):
    start = [(1, "J!", 1, False, None, None), (2, round_, 3, True, wager, "Alice")]
    return start, [(1, 1, "Alice", True), (2, 1, "Alice", right)], [("Alice", score - 200, 1)]


def test_replay(spark):
    assert game(spark, [(1, "J!", 1, False, None, None)], [(1, 1, "Bob", False), (1, 2, "Alice", True), (1, 3, "Charlie", True)]) == {"Alice": (200, 200), "Bob": (-200, -200), "Charlie": (0, 0)}
    assert game(spark, [(i, "Double J!", i, False, None, None) for i in range(1, 6)], [(i, 1, "Bob", True) for i in range(1, 6)])["Bob"] == (6000, 6000)
    for score, wager, right, round_, want in ((1000, "500", True, "J!", 1500), (1000, "500", False, "J!", 500), (3000, "True Daily Double", True, "J!", 6000), (0, "True Daily Double", True, "J!", 1000), (800, "True Daily Double", False, "J!", -200), (500, "True Daily Double", True, "Double J!", 2500)):
        c, a, j = dd(score, wager, right, round_)
        assert game(spark, c, a, j)["Alice"][0] == want
    one_ = [(1, "J!", 1, False, None, None)]
    assert game(spark, one_, [(1, 1, "Zed", True)], [("Alice", 400, 5)], [("Alice", 5000, True), ("Bob", 5000, False), ("Zed", 1, True)]) == {"Alice": (5000, 0), "Bob": (-5000, 0), "Charlie": (0, 0)}
    assert game(spark, [(1, "J!", 3, True, None, "Alice")], [(1, 1, "Alice", True)])["Alice"] == (600, 600)  # without a wager: face value


def test_dedup_and_rows(spark):
    c = spark.createDataFrame([(1, 2500.0, "A", "short"), (2, 2600.0, "a ", "a longer text"), (3, 6500.0, "A", "x"), (4, 1999.0, "B", "x"), (5, 2001.0, "B", "x")], "seq int, start_ms double, category string, text string").withColumns({"episode": F.lit(1), "round": F.lit("J!"), "n_attempts": F.lit(0)})
    assert sorted(r.seq for r in ordered.dedup(c).collect()) == [2, 3, 4]
    r = spark.createDataFrame([(1, 3), (2, 3), (3, 9), (4, 1), (5, 3)], "seq int, board_row int").withColumns({"episode": F.lit(1), "round": F.lit("J!"), "category": F.lit("A")})
    assert [x.fixed_row for x in ordered.repair_rows(r).orderBy("seq").collect()] == [3, 2, 4, 1, 5]


def test_names(spark):
    p = spark.createDataFrame([(1, 1, "Rachel Bernstein"), (1, 2, "Scott Riccardi"), (1, 3, "W. Kamau Bell")], "episode int, seq int, name string")
    a = spark.createDataFrame([(1, x) for x in ("rachel", "Rachael", "S00", "kamau", "XYZ_MYSTERY_PLAYER", "ricc")], "episode int, speaker string")
    hosts = spark.createDataFrame([(1, "S00")], "episode int, speaker string")
    got = {r.speaker: r.who for r in names.resolve(a, p, hosts).collect()}
    assert got == {"rachel": "Rachel Bernstein", "Rachael": "Rachel Bernstein", "kamau": "W. Kamau Bell", "ricc": "Scott Riccardi"}
    m = spark.createDataFrame([(1, "S1", "Rachle"), (1, "S2", "Some Host"), (1, "S3", "qqqqqqqqqqq")], "episode int, id string, name string")
    assert {r.id: r.resolved for r in names.reconcile(m, p, ["some host"]).collect()} == {"S1": "Rachel Bernstein", "S2": "Some Host", "S3": "qqqqqqqqqqq"}


def test_flatten(spark, tmp_path):
    clue = lambda i, a, **k: dict(round="J!", category="A", board_row=1, board_col=1, selection_order=i, is_daily_double=False, host_start_timestamp_ms=0.0, host_finish_timestamp_ms=1000.0, clue_text="t", correct_response="r", attempts=a) | k
    tries = lambda *w: [dict(attempt_order=i + 1, speaker=s, is_correct=i == 0, buzz_timestamp_ms=1500.0) for i, s in enumerate(w)]
    import json

    episode = dict(episode_date="2024-01-01", host_name="h", is_tournament=False, contestants=[dict(name=n, podium_position=i + 1) for i, n in enumerate(("Alice", "Bob B"))], clues=[clue(1, tries("Alice", "GHOST")), clue(2, [], is_daily_double=True, daily_double_wager="500", wagerer_name="Bob B")], final_jep=dict(category="c", clue_text="t", correct_response="r", wagers_and_responses=[dict(contestant="Alice", wager=10, response="x", is_correct=True)]), score_adjustments=[dict(contestant="GHOST", points_adjusted=5, reason="", effective_after_clue_selection_order=1)])
    (tmp_path / "episode_ep1.json").write_text(json.dumps(episode))
    t = tables.flatten(io.read_episodes(spark, f"file://{tmp_path}"))
    assert {k: v.count() for k, v in t.items()} == {"episodes": 1, "contestants": 2, "episode_performances": 2, "clues": 3, "buzz_attempts": 2, "wagers": 2, "score_adjustments": 0}
    assert t["buzz_attempts"].filter("attempt_order = 1 AND clue_id = 'ep1_c1'").first().true_buzzer_latency_ms == 500
    assert all(r.n == 0 for n in ("contestants", "episode_performances", "clues", "buzz_attempts", "wagers") for r in tables.violations(n, t).collect())
    assert "struct" in EPISODE


def test_sources(spark, tmp_path):
    (tmp_path / "Season 41").mkdir()
    for n in ("a.mp4", "b.TS", "c.txt", "Season 41/S41 E01.mkv"):
        (tmp_path / n).write_text("x")
    f = io.scan_files(spark, f"file://{tmp_path}")
    state = spark.createDataFrame([("a", "COMPLETED", 0, None), ("Season_41_S41_E01", "PENDING", 1, "e")], "episode_id string, status string, retry_count int, last_error string")
    assert {r.episode_id: r.status for r in io.discovered(f, state).collect()} == {"a": "COMPLETED", "b": "New", "Season_41_S41_E01": "PENDING"}
    assert {r.episode_id for r in io.discovered(f, state, "verify").collect()} == {"b", "Season_41_S41_E01"}


def test_stream_state(spark, tmp_path):
    rows = [(1, 1, "ok", None), (1, 2, "ok", None), (2, 1, "fail", "e"), (2, 2, "fail", "e"), (2, 3, "fail", "e"), (2, 4, "fail", "x" * 600)]
    spark.createDataFrame(rows, "id long, seq int, outcome string, error string").coalesce(1).write.parquet(f"{tmp_path}/in")
    s = queue.stream(spark.readStream.schema("id long, seq int, outcome string, error string").parquet(f"{tmp_path}/in"))
    q = s.writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.id: (r.status, r.retry_count, r.last_error and len(r.last_error)) for r in spark.table("states").collect()}
    assert got == {1: ("TRANSCRIPT_READY", 0, None), 2: ("FAILED", 3, 500)}


def test_commit(spark, tmp_path):
    from cluelake.sources import commit

    t = {"a": spark.range(3), "b": spark.range(2)}
    assert commit.write_batch(t, f"file://{tmp_path}/w", "1") and not commit.write_batch(t, f"file://{tmp_path}/w", "1")
    commit.stream_sink(f"file://{tmp_path}/w", lambda d: {"a": d, "b": d})(spark.range(5), 2)
    assert commit.read_table(spark, f"file://{tmp_path}/w", "a").count() == 8
    q = spark.createDataFrame([(1, True), (2, False)], "episode int, accepted boolean")
    good, bad = commit.routed(spark.range(1, 4).withColumnRenamed("id", "episode"), q)
    assert (good.count(), bad.count()) == (1, 2) and commit.with_model(good).count() == 1


def test_hosts(spark):
    known = spark.createDataFrame([(1, "Some Host"), (2, "Other Person")], "seq int, host string")
    e = spark.createDataFrame([(1, "some host"), (2, "Contestant"), (3, "x")], "episode int, host_name string")
    m = spark.createDataFrame([(2, "S0", "person"), (3, "S0", "nobody")], "episode int, id string, name string")
    assert {r.episode: r.host for r in names.hosts(e, m, known, "d").collect()} == {1: "Some Host", 2: "Other Person", 3: "d"}
    p = spark.createDataFrame([(2, 1, "Nobody")], "episode int, seq int, name string")
    assert names.mapped_to_known(m, p, names.hosts(e, m, known, "Person")).count() == 0  # "person" and "nobody" of other episodes
    w = spark.createDataFrame([(1, "FAILED", 3, "e"), (2, "SAVING", 0, None)], "id int, status string, retry_count int, last_error string")
    assert {r.id: r.status for r in queue.stage_reset(w, "extract").collect()} == {1: "TRANSCRIPT_READY", 2: "SAVING"}
    assert not queue.may_end(w, "SAVING").first().drained and queue.may_end(w, "PENDING", True).first().drained
