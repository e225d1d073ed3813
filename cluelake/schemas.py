"""Explicit schemas of the nested records and contracts of the relational tables."""

from __future__ import annotations

from dataclasses import dataclass, field

ATTEMPT = "struct<attempt_order:int,speaker:string,response_given:string,is_correct:boolean,buzz_timestamp_ms:double,response_start_timestamp_ms:double,is_lockout_inferred:boolean>"
CLUE = (
    "struct<round:string,category:string,board_row:int,board_col:int,selection_order:int,is_daily_double:boolean,requires_visual_context:boolean,"
    "host_start_timestamp_ms:double,host_finish_timestamp_ms:double,clue_syllable_count:int,daily_double_wager:string,wagerer_name:string,clue_text:string,"
    f"correct_response:string,is_verified:boolean,original_response:string,attempts:array<{ATTEMPT}>>"
)
CONTESTANT = "struct<name:string,podium_position:int,occupational_category:string,is_returning_champion:boolean,description:string>"
FINAL = "struct<category:string,clue_text:string,correct_response:string,wagers_and_responses:array<struct<contestant:string,wager:int,response:string,is_correct:boolean>>>"
ADJUSTMENT = "struct<contestant:string,points_adjusted:int,reason:string,effective_after_clue_selection_order:int>"
EPISODE = f"episode_date string, host_name string, is_tournament boolean, contestants array<{CONTESTANT}>, clues array<{CLUE}>, final_jep {FINAL}, score_adjustments array<{ADJUSTMENT}>"
SEGMENT = "struct<text:string,start:double,end:double,speaker:string,words:array<struct<word:string,start:double,end:double,prob:double>>>"
TRANSCRIPT = f"status string, video_filepath string, transcript struct<segments:array<{SEGMENT}>>"


@dataclass(frozen=True)
class Contract:
    """Keys and checks of a table. foreign: column -> (table, column); checks: SQL predicates that every row meets."""

    key: tuple[str, ...]
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    checks: tuple[str, ...] = ()


CONTRACTS = {
    "pipeline_state": Contract(("episode_id",), required=("status",)),
    "episodes": Contract(("episode_id",)),
    "contestants": Contract(("contestant_id",), required=("name",)),
    "episode_performances": Contract(("episode_id", "contestant_id"), {"episode_id": ("episodes", "episode_id"), "contestant_id": ("contestants", "contestant_id")}, checks=("podium_position IN (1, 2, 3)",)),
    "clues": Contract(("clue_id",), {"episode_id": ("episodes", "episode_id")}, ("round",), ("round IN ('J!', 'Double J!', 'Final J!', 'Tiebreaker')",)),
    "buzz_attempts": Contract(("attempt_id",), {"clue_id": ("clues", "clue_id"), "contestant_id": ("contestants", "contestant_id")}),
    "wagers": Contract(("wager_id",), {"clue_id": ("clues", "clue_id"), "contestant_id": ("contestants", "contestant_id")}),
    "score_adjustments": Contract(("adjustment_id",), {"contestant_id": ("contestants", "contestant_id")}),
    "job_telemetry": Contract(("episode_id",)),
}
