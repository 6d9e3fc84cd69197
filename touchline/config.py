"""Settings of the scouting model: layouts, keywords, weights, thresholds."""

# Results depend on these exact names, words and numbers.

NAME_ACCENTS = "áàäâãåāçćčďéèëêěíìïîłńñóòöôøřšşśťúùüûýÿž"
NAME_PLAIN = "aaaaaaaaccceeeeeiiiilnnooooorssstuuuuyyz"

# The map above pairs its letters by position and is one `a` too long, so from
# `ç` on each letter takes its neighbour's plain form. Aligned alternative:
ALIGNED_PLAIN = "aaaaaaacccdeeeeeiiiilnnooooorssstuuuuyyz"

KEEPER_WORDS = ("gk", "goalkeeper", "goalie", "portero", "gardien", "torwart")
KEEPER_HEADERS = (
    "saves",
    "goals_conceded",
    "clean_sheets",
    "save_percentage",
    "save_pct",
    "penalties_faced",
    "penalties_saved",
    "goals_against",
    "shots_on_target_against",
)

UNKNOWN_LEAGUE = "UNKNOWN_LEAGUE"
UNKNOWN_TEAM = "UNKNOWN_TEAM"

# Cell texts that the usual CSV reader of data frames takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

MATCH_WEIGHTS = {"name": 75, "team": 15, "same_team": 10}
NAME_SIMILARITY_ABOVE = 87
TEAM_SIMILARITY_ABOVE = 85

RECENCY_WEIGHTS = (0.60, 0.30, 0.10)
DECAY_BASE = 0.7

ROLE_MISMATCH = 0.75
TOP_N = 5

OUTFIELD_FEATURES = (
    "goals_per_90",
    "assists_per_90",
    "shots_per_90",
    "interceptions",
    "tackles_won",
    "yellow_cards",
    "red_cards",
    "points_per_match",
    "goal_difference_per_90",
    "on_off_difference",
)
GOALKEEPER_FEATURES = (
    "save_percentage",
    "goals_conceded_per_90",
    "clean_sheet_percentage",
    "saves",
    "shots_on_target_against",
    "wins",
    "draws",
    "losses",
    "yellow_cards",
    "red_cards",
)
POSITION_WEIGHTS = {
    "FW": {
        "goals_per_90": 3.0, "assists_per_90": 2.5, "shots_per_90": 2.0,
        "interceptions": 0.5, "tackles_won": 0.5, "yellow_cards": 0.3,
        "red_cards": 0.3, "points_per_match": 1.0,
        "goal_difference_per_90": 1.0, "on_off_difference": 1.0,
    },
    "MF": {
        "goals_per_90": 1.5, "assists_per_90": 2.0, "shots_per_90": 1.0,
        "interceptions": 1.5, "tackles_won": 1.5, "yellow_cards": 0.5,
        "red_cards": 0.5, "points_per_match": 1.5,
        "goal_difference_per_90": 1.0, "on_off_difference": 1.0,
    },
    "DF": {
        "goals_per_90": 0.5, "assists_per_90": 0.5, "shots_per_90": 0.3,
        "interceptions": 3.0, "tackles_won": 3.0, "yellow_cards": 0.8,
        "red_cards": 0.8, "points_per_match": 1.5,
        "goal_difference_per_90": 1.0, "on_off_difference": 1.0,
    },
}
DEFAULT_GROUP = "MF"

REPLAY_SPEED = 0.05
REPLAY_CAP_SECONDS = 5.0
POLL_SECONDS = 30
LIVE_STATUSES = ("1", "2", "ht")
NOISE_EVENT = "OffsideGiven"

TOPIC_ALL = "match.events"
TOPIC_GOALS = "match.goals"
TOPIC_SHOTS = "match.shots"
TOPIC_CARDS = "match.cards"

# Text columns of the player feed, by the type they take once cleaned.
PLAYER_TEXT = ("player_position", "preferred_foot", "national_team", "current_club")
PLAYER_INTS = (
    "height_cm", "weight_kg", "player_age",
    "matches_played", "matches_started", "minutes_played",
    "goals", "assists", "goal_contributions", "non_penalty_goals",
    "penalty_goals", "penalty_attempts",
    "full_matches_completed", "unused_substitute_matches",
    "team_goals_while_on_pitch", "team_goals_conceded_while_on_pitch",
    "goal_difference_on_pitch",
    "yellow_cards", "red_cards", "own_goals",
    "goals_conceded", "shots_on_target_against", "saves",
    "wins", "draws", "losses", "clean_sheets",
    "penalties_faced", "penalty_goals_conceded",
)
PLAYER_DOUBLES = (
    "full_90s_played",
    "goals_per_90", "assists_per_90", "goal_contributions_per_90",
    "non_penalty_goals_per_90", "non_penalty_goal_contributions_per_90",
    "total_shots", "shots_on_target", "shots_on_target_percentage",
    "shots_per_90", "shots_on_target_per_90",
    "goals_per_shot", "goals_per_shot_on_target",
    "minutes_per_match", "minutes_percentage", "minutes_per_start",
    "minutes_per_substitution", "points_per_match",
    "goal_difference_per_90", "on_off_difference",
    "fouls_committed", "fouls_drawn", "offsides", "crosses",
    "interceptions", "tackles_won", "penalties_won", "penalties_conceded",
    "goals_conceded_per_90", "save_percentage", "clean_sheet_percentage",
)
SALARY_CURRENCIES = {"gbp": "£", "eur": "€", "usd": "$"}

OUTFIELD_FACT = (
    "player_age",
    "matches_played", "matches_started", "minutes_played", "full_90s_played",
    "minutes_per_match", "minutes_percentage", "minutes_per_start",
    "full_matches_completed", "minutes_per_substitution",
    "unused_substitute_matches", "points_per_match",
    "goals", "assists", "goal_contributions", "non_penalty_goals",
    "penalty_goals", "penalty_attempts",
    "goals_per_90", "assists_per_90", "goal_contributions_per_90",
    "non_penalty_goals_per_90", "non_penalty_goal_contributions_per_90",
    "total_shots", "shots_on_target", "shots_on_target_percentage",
    "shots_per_90", "shots_on_target_per_90",
    "goals_per_shot", "goals_per_shot_on_target",
    "team_goals_while_on_pitch", "team_goals_conceded_while_on_pitch",
    "goal_difference_on_pitch", "goal_difference_per_90", "on_off_difference",
    "fouls_committed", "fouls_drawn", "offsides", "crosses",
    "interceptions", "tackles_won", "penalties_won", "penalties_conceded",
    "own_goals", "yellow_cards", "red_cards",
    "weekly_salary_gbp", "weekly_salary_eur", "weekly_salary_usd",
    "annual_salary_gbp", "annual_salary_eur", "annual_salary_usd",
)
GOALKEEPER_FACT = (
    "player_age",
    "matches_played", "matches_started", "minutes_played", "full_90s_played",
    "minutes_per_match", "minutes_percentage", "minutes_per_start",
    "full_matches_completed", "points_per_match",
    "goals_conceded", "goals_conceded_per_90", "shots_on_target_against",
    "saves", "save_percentage",
    "wins", "draws", "losses", "clean_sheets", "clean_sheet_percentage",
    "penalties_faced", "penalty_goals_conceded", "penalties_conceded",
    "team_goals_conceded_while_on_pitch", "goal_difference_on_pitch",
    "goal_difference_per_90", "on_off_difference",
    "yellow_cards", "red_cards", "fouls_committed", "own_goals",
    "weekly_salary_gbp", "weekly_salary_eur", "weekly_salary_usd",
    "annual_salary_gbp", "annual_salary_eur", "annual_salary_usd",
)
SEASON_FACT = (
    "player_age",
    "matches_played", "matches_started", "minutes_played", "full_90s_played",
    "goals", "assists", "goal_contributions",
    "goals_per_90", "assists_per_90", "goal_contributions_per_90",
    "total_shots", "shots_per_90",
    "interceptions", "tackles_won", "crosses",
    "yellow_cards", "red_cards",
    "weekly_salary_eur", "annual_salary_eur",
)
OUTFIELD_MART = (
    "goals_per_90", "assists_per_90", "goal_contributions_per_90",
    "shots_per_90", "shots_on_target_per_90",
    "goals_per_shot", "goals_per_shot_on_target",
    "interceptions", "tackles_won",
    "yellow_cards", "red_cards", "fouls_committed",
    "points_per_match", "goal_difference_per_90", "on_off_difference",
    "minutes_played",
)
GOALKEEPER_MART = (
    "save_percentage", "goals_conceded_per_90", "clean_sheet_percentage",
    "shots_on_target_against", "saves",
    "wins", "draws", "losses",
    "penalties_faced", "penalty_goals_conceded",
    "yellow_cards", "red_cards", "fouls_committed",
    "minutes_played",
)
FORWARD_MART = (
    "goals_per_90", "assists_per_90", "shots_per_90",
    "shots_on_target_per_90", "goals_per_shot", "crosses", "fouls_drawn",
    "yellow_cards", "red_cards", "minutes_played",
)

# Field names of a scraped event and the names they take in the event table.
EVENT_RENAMES = {
    "eventId": "event_id", "expandedMinute": "expanded_minute",
    "outcomeType": "outcome_type", "isTouch": "is_touch",
    "playerId": "player_id", "teamId": "team_id",
    "endX": "end_x", "endY": "end_y",
    "blockedX": "blocked_x", "blockedY": "blocked_y",
    "goalMouthZ": "goal_mouth_z", "goalMouthY": "goal_mouth_y",
    "isShot": "is_shot", "cardType": "card_type", "isGoal": "is_goal",
}
EVENT_FLAGS = ("is_shot", "is_goal", "card_type", "is_touch")
EVENT_NUMBERS = ("minute", "second", "x", "y", "end_x", "end_y")
LIVE_EVENT_DDL = (
    "id bigint, event_id bigint, minute int, second float, "
    "team_id bigint, team_name string, player_id bigint, player_name string, "
    "x float, y float, end_x float, end_y float, "
    "is_touch boolean, is_shot boolean, is_goal boolean, card_type boolean, "
    "type_display_name string, outcome_type_display_name string, "
    "period_display_name string, match_url string, event_timestamp timestamp"
)
# Nested display names are read as text, so an object and a bare word both fit.
_PLAYERS = "array<struct<playerId: bigint, name: string>>"
_SIDE = f"struct<teamId: bigint, name: string, players: {_PLAYERS}>"
MATCH_DDL = (
    f"status string, home {_SIDE}, away {_SIDE}, events array<struct<"
    "id: bigint, eventId: bigint, minute: string, second: string, "
    "expandedMinute: int, teamId: bigint, playerId: bigint, "
    "x: string, y: string, endX: string, endY: string, "
    "blockedX: double, blockedY: double, goalMouthY: double, goalMouthZ: double, "
    "isTouch: boolean, isShot: boolean, isGoal: boolean, "
    "cardType: string, type: string, outcomeType: string, period: string>>"
)
# Cut of the embedded match object out of a page's script text.
MATCH_SCRIPT = r"(?s)matchCentreData: (.*?),\n"
