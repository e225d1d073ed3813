"""Golden values of the operators that put clues, names and files together."""

import pytest
from pyspark.sql import functions as F

from cluelake.functions import board, recover, text, timing, vector
from cluelake.operators import names, ordered, tables, transcript
from cluelake.sources import commit
from cluelake.streaming import queue


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_scalars(spark):
    r = one(
        spark,
        a=text.short_error(F.lit("e" * 41)), b=text.short_error(F.lit("e" * 40)), c=timing.buzz_start(F.lit(None).cast("double"), F.lit(True), F.lit(9.0)),
        d=timing.buzz_start(F.lit(5.0), F.lit(False), F.lit(9.0)), e=board.announced_row(F.lit("Trees for $600, please"), F.lit("J!"), F.lit(1)), f=board.announced_row(F.lit("my score is $800"), F.lit("J!"), F.lit(None).cast("int")),
    )
    assert tuple(r) == ("e" * 37 + "...", "e" * 40, 0.0, 9.0, 3, 3)


def test_clue_context_and_splice(spark):
    seg = spark.createDataFrame([("e", i, f"SPEAKER_0{i % 2}", f" text {i} ") for i in range(20)], "episode string, pos long, speaker string, text string")
    c = spark.createDataFrame([("e", 5, 6), ("e", 0, 0)], "episode string, first long, last long")
    got = {r["first"]: r.context.split("\n") for r in transcript.clue_context(c, seg).collect()}
    assert len(got[5]) == 13 and got[5][0] == "L2 [SPEAKER_00]: text 2" and got[5][3].endswith("◄ CLUE START") and got[5][4].endswith("◄ CLUE END")
    assert got[0][0] == "L0 [SPEAKER_00]: text 0 ◄ CLUE START ◄ CLUE END" and len(got[0]) == 9
    k = spark.createDataFrame([("e", 1, 2, 3, "a clue of enough length", "x"), ("e", 2, 2, 3, "short", "x"), ("e", 3, 40, 41, None, "x"), ("e", 4, 7, 2, "", "x")], "episode string, key long, first long, last long, said string, category string")
    assert {r.key: r.text for r in transcript.spliced(k, seg).collect()} == {1: "a clue of enough length", 2: "text 2 text 3", 3: "", 4: "text 7"}


def test_names_by_mapping(spark):
    people = spark.createDataFrame([("e", 0, "Rachel Bernstein"), ("e", 1, "Scott Riccardi"), ("e", 2, "W. Kamau Bell")], "episode string, seq int, name string")
    mapping = spark.createDataFrame([("e", 0, "SPEAKER_00", "Ken Jennings"), ("e", 1, "SPEAKER_01", "Scott")], "episode string, seq int, id string, name string")
    host = spark.createDataFrame([("e", "ken jennings")], "episode string, host string")
    said = ["rachel", "S01", "S1", "S00", "Rachael", "XYZ_MYSTERY_PLAYER", "kamau", "KEN JENNINGS", "SPEAKER_01"]
    s = spark.createDataFrame([("e", x) for x in said], "episode string, speaker string")
    got = {r.speaker: r.who for r in names.swept(s, mapping, people, host).collect()}
    scott = "Scott Riccardi"
    assert got == {"rachel": "Rachel Bernstein", "S01": scott, "S1": scott, "S00": None, "Rachael": "Rachel Bernstein", "XYZ_MYSTERY_PLAYER": None, "kamau": "W. Kamau Bell", "KEN JENNINGS": None, "SPEAKER_01": scott}


def test_speaker_map_of_segments():
    seg = [{"speaker": "SPEAKER_02", "text": "Welcome back Rachel and Scott"}, {"speaker": "SPEAKER_02", "text": "Rachel, this is for Kamau"}, {"speaker": "SPEAKER_01", "text": "x"}, {"speaker": "SPEAKER_00", "text": "y"}]
    assert recover.speaker_map(str(seg), ["Rae Scott"])["SPEAKER_02"] == "Rae Scott" and recover.speaker_map(str(seg), ["Una Known"])["SPEAKER_02"] == "Host"
    assert recover.speaker_map(str(seg)) == {"SPEAKER_02": "Host", "SPEAKER_00": "Rachel", "SPEAKER_01": "Welcome"}


def test_as_of_takes_equal_times(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 2, "b"), (2, 9, "c")], "k int, t int, id string")
    right = spark.createDataFrame([(1, 5, 50), (1, 3, 30), (1, 6, 60), (1, 4, None)], "k int, t int, v int")
    assert {r.id: r.v for r in ordered.as_of(left, right, ["k"], "t", "v").collect()} == {"a": 50, "b": None, "c": None}


def test_table_updates(spark):
    t = spark.createDataFrame([(1, "a")], "id int, x string")
    assert tables.insert(t, t).count() == 2
    with pytest.raises(ValueError, match="y"):
        tables.insert(t, t.withColumnRenamed("x", "y"))
    f = tables.verified_final(spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "episode int, response string"), spark.createDataFrame([(1, "new", "unverifiable"), (2, None, "verified")], "episode int, r string, status string"))
    assert {r.episode: r.response for r in f.collect()} == {1: "new", 2: "old", 3: "old"}


def test_stages_include_one_another():
    done = [set(queue.COMPLETE[x]) for x in ("verify", "augment", "extract", "transcribe")]
    assert all(a < b for a, b in zip(done, done[1:]))
    assert set(queue.ACTIVE["all"]) == set(queue.COMPLETE)


def test_nearest_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector, "BLOCK", 2)
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)] + [(60, [0.0, 0.0, 0.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    q = e.filter("vec_id % 6 = 0")
    got = {(r.qid, r.place): (r.vec_id, r.distance) for r in vector.nearest(q, e, 3).collect()}
    import numpy as np

    for i, a in rows[::6]:
        d = []
        for j, b in rows:
            n = np.linalg.norm(a) * np.linalg.norm(b)
            d.append((round(min(1, max(0, 1 - float(np.dot(a, b)) / n)) if n else 1.0, 6), j))
        best = sorted(x for x in d if x[1] != i)[:3]
        assert [got[i, p + 1] for p in range(3)] == [(j, x) for x, j in best]


def test_scratch_is_in_the_shared_folder(spark):
    assert commit.scratch(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_star_of_games_as_played(spark):
    """True Daily Doubles take the score before them, with or without an attempt; ids are lower-cased with underscores; unknown names drop out."""
    from cluelake.schemas import EPISODE

    def clue(order, row, tries, rnd="J!", wager=None, who=None):
        a = [{"attempt_order": i + 1, "speaker": w, "response_given": "r", "is_correct": ok, "buzz_timestamp_ms": 1500.0, "response_start_timestamp_ms": 1750.0, "is_lockout_inferred": False} for i, (w, ok) in enumerate(tries)]
        return {"round": rnd, "category": "C", "board_row": row, "board_col": 1, "selection_order": order, "is_daily_double": wager is not None, "requires_visual_context": False, "host_start_timestamp_ms": 0.0, "host_finish_timestamp_ms": 1000.0, "clue_syllable_count": 3, "daily_double_wager": wager, "wagerer_name": who, "clue_text": "t", "correct_response": "a", "is_verified": False, "original_response": None, "attempts": a}

    ann, bo = "Ann B. Lee", "Bo"
    clues = [
        clue(1, 5, [(bo, False), ("Stranger", True), (ann, True)]), clue(2, 3, [(ann, True)], wager="True Daily Double", who=ann), clue(3, 1, [], wager="True Daily Double", who=ann),
        clue(4, 2, [(bo, True)], "Double J!", "True Daily Double", bo), clue(5, 1, [(ann, False)], wager="700", who=ann), clue(6, 1, [(ann, True)], wager="True Daily Double", who=None),
    ]
    people = [{"name": n, "podium_position": i + 1, "occupational_category": None, "is_returning_champion": False, "description": None} for i, n in enumerate((ann, bo, "Cy"))]
    final = {"category": "F", "clue_text": "t", "correct_response": "", "wagers_and_responses": [{"contestant": ann, "wager": 100, "response": "r", "is_correct": False}, {"contestant": "Nobody", "wager": 1, "response": "r", "is_correct": True}]}
    fixes = [{"contestant": "Ann B. Lee", "points_adjusted": 50, "reason": "x", "effective_after_clue_selection_order": 1}, {"contestant": "Bo", "points_adjusted": 9, "reason": "x", "effective_after_clue_selection_order": 44}]
    e = spark.createDataFrame([("e1", "2024-01-01", "H", False, people, clues, final, fixes)], f"episode_id string, {EPISODE}")
    star = tables.star(e)
    # Ann: 1000, 50 more, stake 1050 won, -700, 200 (no wagerer: an ordinary clue), -100; Bo: -1000, stake 2000 won
    assert {r.contestant_id: (r.podium_position, r.final_score, r.coryat_score) for r in star["episode_performances"].collect()} == {"e1_ann_b._lee": (1, 1500, 1000 + 600 - 200 + 200), "e1_bo": (2, 1000, -1000 + 800), "e1_cy": (3, 0, 0)}
    assert {r.wager_id: r.actual_wager for r in star["wagers"].collect()} == {"e1_c2_dd": 1050, "e1_c3_dd": 2100, "e1_c4_dd": 2000, "e1_c5_dd": 700, "e1_fj_ann_b._lee": 100}
    rows = {r.clue_id: r for r in star["clues"].collect()}
    assert [rows[f"e1_c{i}"].daily_double_wager for i in (1, 2, 3, 4, 5, 6)] == [None, "1050", "2100", "2000", "700", "True Daily Double"]
    assert (rows["e1_fj"].selection_order, rows["e1_fj"].correct_response, rows["e1_fj"].is_verified, rows["e1_fj"].is_triple_stumper) == (61, None, False, False)
    assert [r.adjustment_id for r in star["score_adjustments"].orderBy("adjustment_id").collect()] == ["e1_adj_1_ann_b._lee", "e1_adj_44_bo"]
    assert star["buzz_attempts"].filter("contestant_id LIKE '%stranger%' OR contestant_id LIKE '%nobody%'").count() == 0
