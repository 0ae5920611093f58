"""Table contracts as Spark DDL.  Column names and types are fixed values."""

from __future__ import annotations

RAW_GAMES = """
    game_id string, white string, black string, result string,
    white_elo string, black_elo string, eco string, opening string,
    time_control string, termination string, utc_date string, utc_time string,
    moves string, clock_annotations string, ingested_at timestamp_ntz,
    batch_id string, source string
"""

SILVER_GAMES = """
    game_id string, white string, black string, white_elo int, black_elo int,
    result string, termination string, result_reason string, eco_code string,
    opening_variation string, opening_family string, time_control_type string,
    base_time_seconds int, increment_seconds int, game_date date,
    game_length int, has_clock_data boolean, clock_seconds array<int>,
    has_capture boolean, capture_count int, white_castled boolean,
    black_castled boolean, legal_prefix_length int, has_bot_player boolean,
    moves_san array<string>, batch_id string, year int, month int,
    elo_bucket string
"""

PLAYER_MONTHS = """
    player string, year int, month int, games_played bigint, wins bigint,
    losses bigint, draws bigint, win_rate double, avg_elo double,
    elo_change int, most_played_opening_white string,
    most_played_opening_black string
"""

OPENINGS = """
    eco_code string, opening_family string, elo_bucket string,
    time_control_type string, year int, games_count bigint,
    white_win_rate double, black_win_rate double, draw_rate double,
    avg_game_length double, most_common_response string
"""

TIME_PRESSURE = """
    time_remaining_bucket string, game_phase string, time_control_type string,
    year int, games_count bigint, evaluated_positions bigint,
    blunder_count bigint, avg_cp_loss double, blunder_rate double
"""

POSITIONS = """
    game_id string, ply_number int, move string, square string,
    game_phase string, time_control_type string, year int, player_elo int,
    time_remaining_seconds int, material_balance int, is_in_check boolean,
    eval_before_cp int, eval_after_cp int, cp_loss int, is_blunder boolean
"""

EVALUATIONS = "game_id string, ply int, eval_cp int"

RESULTS = ["white_win", "black_win", "draw"]
TIME_BUCKETS = ["0-5s", "6-15s", "16-30s", "31-60s", "60s+"]
PHASES = ["opening", "middlegame", "endgame"]


def column_names(ddl: str) -> list[str]:
    """Names in a flat DDL string, in order (no nested type here holds a comma)."""
    return [part.split()[0] for part in ddl.split(",")]
