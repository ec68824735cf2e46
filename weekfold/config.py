"""Fixed values of the feature definitions.

Everything in this module is a list, name or constant that has to equal the
published feature definitions for results to agree; none of it is logic.
"""

from __future__ import annotations

# --- fixed values: windows, bands, thresholds --------------------------------
ROLLING_WINDOWS = (3, 5, 10)
TREND_WINDOW = 5
PERIOD_WEIGHT = 100          # ordinal = season * 100 + week
WEEKS_PER_SEASON = 18
DEFAULT_REST_DAYS = 7
DEFAULT_OPPONENT_RANK = 16
HISTORY_MEETINGS = 3
ALLOWED_STATS = 10
TEAM_LOOKBACK_WEEKS = 3
PLAYS_FIRST_SEASON = 2022
MIN_QUALITY = 0.5
LEAK_WORDS = ("win", "loss", "final", "result", "outcome")

EXPERIENCE = {
    # band: (highest seasons played, strategy, confidence multiplier, code)
    "rookie": (1, "high_variance_model", 0.6, 1),
    "developing": (3, "mixed_model", 0.8, 2),
    "veteran": (None, "historical_trend_model", 1.0, 3),
}

POSITION_CODES = {"QB": 1, "RB": 2, "WR": 3, "TE": 4, "K": 5}
VECTOR_POSITIONS = ("QB", "RB", "WR", "TE", "K")
OFFENSIVE_POSITIONS = ("QB", "RB", "FB", "WR", "TE", "C", "G", "T")
DEFENSIVE_POSITIONS = ("DE", "DT", "NT", "LB", "ILB", "OLB", "CB", "S", "FS", "SS")
POSITION_GROUPS = {
    "QB": ["QB"],
    "RB": ["RB", "FB"],
    "WR": ["WR"],
    "TE": ["TE"],
    "OL": ["C", "G", "T"],
    "DL": ["DE", "DT", "NT"],
    "LB": ["LB", "ILB", "OLB"],
    "DB": ["CB", "S", "FS", "SS"],
    "ST": ["K", "P", "LS"],
}

# --- fixed values: first season each feed exists (None: no bound) ------------
# feed: (first season, last season, loaded once in the earliest season)
FEED_SEASONS = {
    "player_stats": (None, None, False),
    "nextgen_passing": (2016, None, False),
    "nextgen_rushing": (2016, None, False),
    "nextgen_receiving": (2016, None, False),
    "snap_counts": (2012, None, False),
    "team_stats": (None, None, False),
    "schedules": (None, None, False),
    "pbp": (2022, None, False),
    "rosters_weekly": (None, None, False),
    "depth_charts": (None, None, False),
    "players": (None, None, True),
    "ftn_charting": (2022, None, False),
    "participation": (None, 2024, False),
    "draft_picks": (None, None, True),
    "combine": (None, None, True),
}
DEPTH_TIMESTAMP_FIRST_SEASON = 2025

# --- fixed values: identity columns per raw table ----------------------------
KEY_COLUMNS = {
    "raw_player_stats": ["player_id", "season", "week", "season_type"],
    "raw_team_stats": ["team", "season", "week", "season_type"],
    # one player stands on several places of a chart, and charts from 2025 on carry a timestamp
    "raw_depth_charts": ["season", "week", "club_code", "gsis_id", "position", "formation", "depth_team", "dt"],
    "raw_rosters_weekly": ["gsis_id", "team", "season", "week"],
    "raw_schedules": ["game_id"],
    "raw_nextgen_passing": ["player_gsis_id", "season", "week", "season_type"],
    "raw_nextgen_rushing": ["player_gsis_id", "season", "week", "season_type"],
    "raw_nextgen_receiving": ["player_gsis_id", "season", "week", "season_type"],
    "raw_snap_counts": ["pfr_player_id", "season", "week"],
    "raw_pbp": ["play_id", "game_id"],
    "raw_players": ["player_id"],
    "raw_ftn_charting": ["game_id", "play_id"],
    "raw_participation": ["nflverse_game_id", "play_id", "gsis_player_id"],
    "raw_draft_picks": ["season", "round", "pick"],
    "raw_combine": ["season", "pfr_id"],
}
DEFAULT_KEY = ["player_id", "season", "week"]
#: Key columns that a feed carries in some years only.
OPTIONAL_KEY_COLUMNS = {"raw_depth_charts": ["dt"]}

# --- fixed values: statistics per position ------------------------------------
POSITION_STATS = {
    "QB": {
        "passing": [
            "attempts", "completions", "passing_yards", "passing_tds", "passing_interceptions",
            "passing_first_downs", "passing_air_yards", "passing_yards_after_catch",
            "passing_epa", "passing_cpoe", "pacr", "passing_2pt_conversions",
        ],
        "pressure": ["sacks_suffered", "sack_yards_lost", "sack_fumbles", "sack_fumbles_lost"],
        "rushing": [
            "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
            "rushing_fumbles_lost", "rushing_first_downs", "rushing_epa",
            "rushing_2pt_conversions",
        ],
        "recovery": ["fumble_recovery_own", "fumble_recovery_yards_own", "fumble_recovery_tds"],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
    "WR": {
        "receiving": [
            "targets", "receptions", "receiving_yards", "receiving_tds", "receiving_fumbles",
            "receiving_fumbles_lost", "receiving_air_yards", "receiving_yards_after_catch",
            "receiving_first_downs", "receiving_epa", "racr", "target_share", "air_yards_share",
            "wopr", "receiving_2pt_conversions",
        ],
        "rushing": [
            "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
            "rushing_fumbles_lost", "rushing_first_downs", "rushing_epa",
            "rushing_2pt_conversions",
        ],
        "special_teams": [
            "punt_returns", "punt_return_yards", "kickoff_returns", "kickoff_return_yards",
            "special_teams_tds",
        ],
        "recovery": ["fumble_recovery_own", "fumble_recovery_yards_own", "fumble_recovery_tds"],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
    "RB": {
        "rushing": [
            "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
            "rushing_fumbles_lost", "rushing_first_downs", "rushing_epa",
            "rushing_2pt_conversions",
        ],
        "receiving": [
            "targets", "receptions", "receiving_yards", "receiving_tds", "receiving_fumbles",
            "receiving_fumbles_lost", "receiving_air_yards", "receiving_yards_after_catch",
            "receiving_first_downs", "receiving_epa", "racr", "target_share", "air_yards_share",
            "wopr", "receiving_2pt_conversions",
        ],
        "special_teams": ["kickoff_returns", "kickoff_return_yards", "special_teams_tds"],
        "recovery": ["fumble_recovery_own", "fumble_recovery_yards_own", "fumble_recovery_tds"],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
    "TE": {
        "receiving": [
            "targets", "receptions", "receiving_yards", "receiving_tds", "receiving_fumbles",
            "receiving_fumbles_lost", "receiving_air_yards", "receiving_yards_after_catch",
            "receiving_first_downs", "receiving_epa", "racr", "target_share", "air_yards_share",
            "wopr", "receiving_2pt_conversions",
        ],
        "rushing": [
            "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
            "rushing_fumbles_lost", "rushing_first_downs", "rushing_epa",
            "rushing_2pt_conversions",
        ],
        "special_teams": ["kickoff_returns", "kickoff_return_yards", "special_teams_tds"],
        "recovery": ["fumble_recovery_own", "fumble_recovery_yards_own", "fumble_recovery_tds"],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
    "K": {
        "field_goals": [
            "fg_att", "fg_made", "fg_missed", "fg_blocked", "fg_pct", "fg_long", "fg_made_0_19",
            "fg_made_20_29", "fg_made_30_39", "fg_made_40_49", "fg_made_50_59", "fg_made_60_",
            "fg_missed_0_19", "fg_missed_20_29", "fg_missed_30_39", "fg_missed_40_49",
            "fg_missed_50_59", "fg_missed_60_", "fg_made_list", "fg_missed_list",
            "fg_blocked_list", "fg_made_distance", "fg_missed_distance", "fg_blocked_distance",
        ],
        "extra_points": ["pat_att", "pat_made", "pat_missed", "pat_blocked", "pat_pct"],
        "game_winning": ["gwfg_att", "gwfg_made", "gwfg_missed", "gwfg_blocked", "gwfg_distance"],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
    "DEF": {
        "tackling": [
            "def_tackles_solo", "def_tackles_with_assist", "def_tackle_assists",
            "def_tackles_for_loss", "def_tackles_for_loss_yards",
        ],
        "pass_rush": ["def_sacks", "def_sack_yards", "def_qb_hits"],
        "coverage": ["def_interceptions", "def_interception_yards", "def_pass_defended"],
        "turnovers": ["def_fumbles_forced"],
        "scoring": ["def_tds", "def_safeties"],
        "recovery": [
            "fumble_recovery_own", "fumble_recovery_yards_own", "fumble_recovery_opp",
            "fumble_recovery_yards_opp", "fumble_recovery_tds",
        ],
        "own_fumbles": ["def_fumbles"],
        "special_teams": [
            "punt_returns", "punt_return_yards", "kickoff_returns", "kickoff_return_yards",
            "special_teams_tds",
        ],
        "universal": ["misc_yards", "penalties", "penalty_yards"],
    },
}

# the statistic a defence is ranked on, per position it faces
RANK_METRIC = {
    "QB": "passing_yards",
    "RB": "rushing_yards",
    "WR": "receiving_yards",
    "TE": "receiving_yards",
    "K": "fg_made",
    "DEF": "def_tackles_solo",
}

# --- fixed values: composite trend weights ------------------------------------
# performance = sum(weight * slope * scale); "fallback" is used alone when one
# of the weighted statistics is not in the input
TREND_WEIGHTS = {
    "QB": {
        "terms": [("passing_yards", 0.6, 1), ("passing_tds", 0.3, 20), ("rushing_yards", 0.1, 1)],
        "fallback": None,
        "usage": ["attempts"],
        "share": None,
    },
    "RB": {
        "terms": [("rushing_yards", 0.6, 1), ("receiving_yards", 0.3, 1), ("carries", 0.1, 4)],
        "fallback": "rushing_yards",
        "usage": ["carries", "targets"],
        "share": "target_share",
    },
    "WR": {
        "terms": [("receiving_yards", 0.7, 1), ("targets", 0.3, 10)],
        "fallback": "receiving_yards",
        "usage": ["targets"],
        "share": "target_share",
    },
    "TE": {
        "terms": [("receiving_yards", 0.7, 1), ("targets", 0.3, 10)],
        "fallback": "receiving_yards",
        "usage": ["targets"],
        "share": "target_share",
    },
    "K": {
        "terms": None,
        "fallback": "fg_pct",
        "usage": ["fg_att"],
        "share": None,
    },
    "DEF": {
        "terms": [("def_tackles_solo", 0.5, 1), ("def_sacks", 0.3, 2), ("def_interceptions", 0.2, 3)],
        "fallback": None,
        "usage": ["def_tackles_solo"],
        "share": None,
    },
}

# --- fixed values: team metrics and their defaults ----------------------------
TEAM_METRICS = {
    "off_epa_per_play_last3": 0.0,
    "off_success_rate_last3": 0.5,
    "off_explosive_play_rate": 0.0,
    "off_red_zone_efficiency": 0.5,
    "off_third_down_conv": 0.0,
    "def_epa_per_play_last3": 0.0,
    "def_success_rate_last3": 0.5,
    "def_pressure_rate": 0.0,
    "def_turnover_rate": 0.0,
    "pass_rate_neutral": 0.5,
    "pace_of_play": 65.0,
    "time_of_possession_avg": 30.0,
}

# --- fixed values: the 47-slot feature vector ---------------------------------
VECTOR_UNIVERSAL = (
    "performance_trend", "usage_trend", "target_share_trend",
    "opp_rank_vs_position", "rest_days",
    "off_epa_per_play_last3", "off_success_rate_last3", "off_explosive_play_rate",
    "off_red_zone_efficiency", "off_third_down_conv", "pass_rate_neutral",
    "pace_of_play", "time_of_possession_avg",
    "opp_def_epa_per_play_last3", "opp_def_success_rate_last3",
    "opp_def_pressure_rate", "opp_def_turnover_rate",
)
# (statistic, name inside the vector) for each of the ten slots of a window
VECTOR_STATS = {
    "QB": [
        ("passing_yards", "passing_yards"),
        ("passing_tds", "passing_tds"),
        ("completions", "completions"),
        ("attempts", "attempts"),
        ("passing_epa", "passing_epa"),
        ("sacks_suffered", "sacks"),
        ("carries", "carries"),
        ("rushing_yards", "rushing_yards"),
        ("rushing_tds", "rushing_tds"),
        ("fantasy_points", "fantasy_points"),
    ],
    "RB": [
        ("carries", "carries"),
        ("rushing_yards", "rushing_yards"),
        ("rushing_tds", "rushing_tds"),
        ("targets", "targets"),
        ("receptions", "receptions"),
        ("receiving_yards", "receiving_yards"),
        ("receiving_tds", "receiving_tds"),
        ("rushing_epa", "rushing_epa"),
        ("receiving_epa", "receiving_epa"),
        ("fantasy_points", "fantasy_points"),
    ],
    "WR": [
        ("targets", "targets"),
        ("receptions", "receptions"),
        ("receiving_yards", "receiving_yards"),
        ("receiving_tds", "receiving_tds"),
        ("receiving_epa", "receiving_epa"),
        ("target_share", "target_share"),
        ("air_yards_share", "air_yards_share"),
        ("carries", "carries"),
        ("rushing_yards", "rushing_yards"),
        ("fantasy_points", "fantasy_points"),
    ],
    "TE": [
        ("targets", "targets"),
        ("receptions", "receptions"),
        ("receiving_yards", "receiving_yards"),
        ("receiving_tds", "receiving_tds"),
        ("receiving_epa", "receiving_epa"),
        ("target_share", "target_share"),
        ("air_yards_share", "air_yards_share"),
        ("carries", "carries"),
        ("rushing_yards", "rushing_yards"),
        ("fantasy_points", "fantasy_points"),
    ],
    "K": [
        ("fg_att", "fg_att"),
        ("fg_made", "fg_made"),
        ("fg_pct", "fg_pct"),
        ("pat_made", "pat_made"),
        ("pat_att", "pat_att"),
        (None, "pad1"),
        (None, "pad2"),
        (None, "pad3"),
        (None, "pad4"),
        (None, "pad5"),
    ],
}
# vector prefix -> rolling window it reads
VECTOR_WINDOWS = {"last3": 3, "last5": 5, "season": 10}

# --- fixed values: prediction targets -----------------------------------------
POSITION_TARGETS = {
    "QB": ["passing_yards", "passing_tds", "passing_interceptions", "completions",
           "attempts", "rushing_yards", "rushing_tds", "fantasy_points_ppr"],
    "RB": ["rushing_yards", "rushing_tds", "carries", "receptions",
           "receiving_yards", "receiving_tds", "fantasy_points_ppr"],
    "WR": ["receiving_yards", "receiving_tds", "receptions", "targets",
           "catch_rate", "rushing_yards", "fantasy_points_ppr"],
    "TE": ["receiving_yards", "receiving_tds", "receptions", "targets",
           "catch_rate", "fantasy_points_ppr"],
    "K": ["fg_made", "fg_att", "fg_pct", "pat_made", "pat_att",
          "fantasy_points_standard"],
}
PRIMARY_TARGET = {
    "QB": "passing_yards",
    "RB": "rushing_yards",
    "WR": "receiving_yards",
    "TE": "receiving_yards",
    "K": "fg_made",
}
DEFAULT_PRIMARY_TARGET = "fantasy_points_ppr"
# outcomes recorded per position: plain statistics, then (name, over, under) rates
OUTCOMES = {
    "QB": {
        "stats": ["passing_yards", "passing_tds", "passing_interceptions", "completions",
                  "attempts", "passing_epa", "rushing_yards", "rushing_tds",
                  "fantasy_points_ppr"],
        "rates": [("completion_pct", "completions", "attempts")],
    },
    "RB": {
        "stats": ["rushing_yards", "rushing_tds", "carries", "receiving_yards",
                  "receiving_tds", "receptions", "targets", "fantasy_points_ppr"],
        "rates": [("yards_per_carry", "rushing_yards", "carries")],
    },
    "WR": {
        "stats": ["receiving_yards", "receiving_tds", "receptions", "targets",
                  "target_share", "air_yards_share", "rushing_yards",
                  "fantasy_points_ppr"],
        "rates": [("catch_rate", "receptions", "targets"),
                  ("yards_per_reception", "receiving_yards", "receptions")],
    },
    "TE": {
        "stats": ["receiving_yards", "receiving_tds", "receptions", "targets",
                  "target_share", "fantasy_points_ppr"],
        "rates": [("catch_rate", "receptions", "targets"),
                  ("yards_per_reception", "receiving_yards", "receptions")],
    },
    "K": {
        "stats": ["fg_made", "fg_att", "fg_pct", "pat_made", "pat_att"],
        "rates": [],
    },
}

# --- fixed values: quality score steps (lower bound -> score) -----------------
COMPLETENESS_STEPS = ((0.9, 1.0), (0.75, 0.8), (0.5, 0.6), (0.25, 0.3))
# upper bound -> score
OUTLIER_STEPS = ((0, 1.0), (2, 0.9), (5, 0.7), (10, 0.5))
RECENCY_STEPS = ((4, 1.0), (8, 0.9), (17, 0.8), (35, 0.7))
EXTREME_VALUE = 1000.0
QUALITY_WEIGHTS = {"completeness": 0.6, "outlier": 0.2, "recency": 0.2}

# --- fixed values: boosted tree settings --------------------------------------
REGRESSION_TREES = {"maxDepth": 6, "stepSize": 0.05, "maxIter": 200, "subsamplingRate": 0.8, "seed": 42}
CLASSIFICATION_TREES = {"maxDepth": 5, "stepSize": 0.05, "maxIter": 200, "subsamplingRate": 0.8, "seed": 42}
# of trees grown for many models at once: these also sample columns and penalise leaves
TREE_PENALTIES = {"columns": 0.8, "least_weight": 3.0, "gamma": 0.1, "alpha": 0.1, "penalty": 1.0}
CLASSIFICATION_TARGETS = ("win_probability", "over_under", "td_scored", "first_down_conversion")
MIN_TRAINING_ROWS = 10


def position_stats(position: str) -> list[str]:
    """All configured statistics of a position, in category order."""
    return [s for names in POSITION_STATS.get(position, {}).values() for s in names]


def all_stats() -> list[str]:
    """Every configured statistic once, in first-seen order."""
    return list(dict.fromkeys(s for p in POSITION_STATS for s in position_stats(p)))


def vector_names(position: str) -> list[str]:
    """The 47 feature names of a position, parallel to its value array."""
    return list(VECTOR_UNIVERSAL) + [
        f"{prefix}_{name}" for prefix in VECTOR_WINDOWS for _, name in VECTOR_STATS[position]
    ]
