"""Team form over the last three weeks, from play events.

All metrics come from one chain of shrinking aggregates: plays -> drives ->
team-weeks -> three-week windows. Only the first step reads plays, and it
combines on the map side, so a team or drive with many plays is reduced before
the shuffle; everything after works on tables sized by drives or by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.scalars import clock_seconds
from weekfold.operators.windows import spread_forward

GAME_DRIVE = ("game_id", "drive")
_TUPLE = ("drive_play_count", "drive_time_of_possession")
# per-drive sums, added up unchanged at every later level
_OFF_SUMS = (
    "off_plays", "off_epa", "off_success", "off_long", "third_converted", "third_failed",
    "neutral_pass", "neutral_rush", "reg_plays",
)
_DEF_SUMS = (
    "def_plays", "def_epa", "def_epa_plays", "def_stops", "qb_hits", "sacks", "def_passes",
    "interceptions", "fumbles",
)
_OFF_DRIVE_SUMS = ("rz_drives", "rz_scores", "paces", "pace_plays", "clocks", "clock_seconds")
_DEF_DRIVE_SUMS = ("def_drives",)


# --- conditions on a play ---------------------------------------------------------
_SCRIMMAGE = "play_type IN ('pass', 'run') AND play = 1"
_OFFENCE = f"{_SCRIMMAGE} AND epa IS NOT NULL"
_THIRD = f"{_OFFENCE} AND down = 3"
_NEUTRAL = (
    "score_differential BETWEEN -7 AND 7 AND quarter_seconds_remaining > 120 "
    "AND down IN (1, 2) AND play = 1"
)
_PLAY_SUMS = {
    "off_plays": f"count_if({_OFFENCE})",
    "off_epa": f"sum(epa) FILTER (WHERE {_OFFENCE})",
    "off_success": f"count_if({_OFFENCE} AND success = 1)",
    "off_long": f"count_if({_OFFENCE} AND yards_gained > 10)",
    "third_converted": f"sum(third_down_converted) FILTER (WHERE {_THIRD})",
    "third_failed": f"sum(third_down_failed) FILTER (WHERE {_THIRD})",
    "neutral_pass": f"sum(pass_attempt) FILTER (WHERE {_NEUTRAL})",
    "neutral_rush": f"sum(rush_attempt) FILTER (WHERE {_NEUTRAL})",
    "reg_plays": "count_if(season_type = 'REG')",
    "in_red": "max(1) FILTER (WHERE yardline_100 <= 20)",
    "red_score": "max(touchdown) FILTER (WHERE yardline_100 <= 20)",
    "def_plays": f"count_if({_SCRIMMAGE})",
    "def_epa": f"sum(epa) FILTER (WHERE {_SCRIMMAGE})",
    "def_epa_plays": f"count_if({_OFFENCE})",
    "def_stops": f"count_if({_SCRIMMAGE} AND success = 0)",
    "qb_hits": f"sum(qb_hit) FILTER (WHERE {_SCRIMMAGE})",
    "sacks": f"sum(sack) FILTER (WHERE {_SCRIMMAGE})",
    "def_passes": f"sum(pass_attempt) FILTER (WHERE {_SCRIMMAGE})",
    "interceptions": f"sum(interception) FILTER (WHERE {_SCRIMMAGE})",
    "fumbles": f"sum(fumble_lost) FILTER (WHERE {_SCRIMMAGE})",
}
_PACED = "drive IS NOT NULL AND drive_play_count IS NOT NULL"
# what one drive adds, whatever number of (play count, clock) records it has
_DRIVE_SUMS = {
    "rz_drives": "max(in_red) FILTER (WHERE drive IS NOT NULL)",
    "rz_scores": "max(red_score) FILTER (WHERE drive IS NOT NULL)",
    "paces": f"count_if({_PACED})",
    "pace_plays": f"sum(drive_play_count) FILTER (WHERE {_PACED})",
    "clocks": f"count(seconds) FILTER (WHERE {_PACED})",
    "clock_seconds": f"sum(seconds) FILTER (WHERE {_PACED})",
    "def_drives": "max(1) FILTER (WHERE drive IS NOT NULL AND def_plays > 0)",
}


def _named(exprs: dict[str, str], names=None) -> list[Column]:
    return [F.expr(f"{sql} AS {n}") for n, sql in exprs.items() if names is None or n in names]


def drive_facts(plays: DataFrame) -> DataFrame:
    """One row per drive (and per recorded play count and clock of it)."""
    keys = ["posteam", "defteam", "season", "week", *GAME_DRIVE, *_TUPLE]
    return plays.groupBy(*keys).agg(*_named(_PLAY_SUMS))


def _fold_drives(facts: DataFrame, keys, columns) -> DataFrame:
    """Drive facts folded to one row per drive, keeping the given columns."""
    timed = facts.withColumn("seconds", clock_seconds("drive_time_of_possession"))
    sums = {c: f"sum({c})" for c in columns if c in _PLAY_SUMS}
    return timed.groupBy(*keys).agg(*_named(sums), *_named(_DRIVE_SUMS, set(columns)))


def _drives(facts: DataFrame, team: str, period, drive_key) -> DataFrame:
    known = facts.filter(F.col(team).isNotNull()).withColumn("team", F.col(team))
    return _fold_drives(known, ["team", *period, *drive_key], _columns(team))


def _columns(team: str):
    return (*_OFF_SUMS, *_OFF_DRIVE_SUMS) if team == "posteam" else (*_DEF_SUMS, *_DEF_DRIVE_SUMS)


def _fold(df: DataFrame, columns, keys) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"sum({c}) AS {c}") for c in columns])


def _side(plays: DataFrame, team: str, drive_key=GAME_DRIVE) -> DataFrame:
    """Three-week totals of one side per (team, season, target week)."""
    facts, columns = drive_facts(plays), _columns(team)
    if "game_id" in drive_key:
        # a drive lies inside one week, so weekly totals add up
        weekly = _fold(_drives(facts, team, ("season", "week"), drive_key), columns, ["team", "season", "week"])
        return _fold(spread_forward(weekly), columns, ["team", "season", "target_week"])
    # a drive id shared by several games counts once per window
    spread = _drives(spread_forward(facts), team, ("season", "target_week"), drive_key)
    return _fold(spread, columns, ["team", "season", "target_week"])


# metric: (numerator, denominator) over three-week totals
_RATIOS = {
    "off_epa_per_play_last3": ("off_epa", "off_plays"),
    "off_success_rate_last3": ("off_success", "off_plays"),
    "off_explosive_play_rate": ("off_long", "off_plays"),
    "off_red_zone_efficiency": ("rz_scores", "rz_drives"),
    "off_third_down_conv": ("third_converted", "third_converted + third_failed"),
    "def_epa_per_play_last3": ("def_epa", "def_epa_plays"),
    "def_success_rate_last3": ("def_stops", "def_plays"),
    "def_pressure_rate": ("qb_hits + sacks", "def_passes"),
    "def_turnover_rate": ("interceptions + fumbles", "def_drives"),
    "pass_rate_neutral": ("neutral_pass", "neutral_pass + neutral_rush"),
    "pace_of_play": ("pace_plays", "paces"),
    "time_of_possession_avg": ("clock_seconds", "clocks * 60"),
}


def _metrics(names) -> list[Column]:
    """Metric columns from three-week totals, defaults filled in."""
    return [
        F.expr(
            f"coalesce(cast({_RATIOS[n][0]} AS double) / nullif(cast({_RATIOS[n][1]} AS double), 0D), "
            f"{float(config.TEAM_METRICS[n])}D) AS {n}"
        )
        for n in names
    ]


def _select(df: DataFrame, names) -> DataFrame:
    return df.select("team", "season", F.col("target_week").alias("week"), *_metrics(names))


OFFENCE = ("off_epa_per_play_last3", "off_success_rate_last3", "off_explosive_play_rate", "off_third_down_conv")
RED_ZONE = ("off_red_zone_efficiency",)
DEFENCE = ("def_epa_per_play_last3", "def_success_rate_last3", "def_pressure_rate", "def_turnover_rate")
NEUTRAL = ("pass_rate_neutral",)
PACE = ("pace_of_play", "time_of_possession_avg")


def offence(plays: DataFrame) -> DataFrame:
    return _select(_side(plays, "posteam"), OFFENCE)


def red_zone(plays: DataFrame, drive_key=GAME_DRIVE) -> DataFrame:
    return _select(_side(plays, "posteam", drive_key), RED_ZONE)


def defence(plays: DataFrame, drive_key=GAME_DRIVE) -> DataFrame:
    return _select(_side(plays, "defteam", drive_key), DEFENCE)


def neutral_pass_rate(plays: DataFrame) -> DataFrame:
    return _select(_side(plays, "posteam"), NEUTRAL)


def pace(plays: DataFrame, drive_key=GAME_DRIVE) -> DataFrame:
    return _select(_side(plays, "posteam", drive_key), PACE)


def _both_sides(plays: DataFrame) -> DataFrame:
    """Weekly totals with offence and defence side by side, from one drive table."""
    off_cols, def_cols = _columns("posteam"), _columns("defteam")
    drives = _fold_drives(
        drive_facts(plays), ["posteam", "defteam", "season", "week", *GAME_DRIVE], (*off_cols, *def_cols)
    )
    # totals per pairing first, then each pairing counts for both of its teams
    pairs = _fold(drives, (*off_cols, *def_cols), ["posteam", "defteam", "season", "week"])
    order = sorted((*off_cols, *def_cols))

    def side(team: str, mine) -> str:
        fields = ", ".join(f"if({'true' if c in mine else 'false'}, {c}, NULL) AS {c}" for c in order)
        return f"struct({team} AS team, {fields})"

    sides = pairs.selectExpr(
        "season", "week",
        f"explode(array({side('posteam', off_cols)}, {side('defteam', def_cols)})) AS side",
    ).select("season", "week", "side.*")
    return _fold(sides.filter(F.col("team").isNotNull()), order, ["team", "season", "week"])


def team_aggregates(
    plays: DataFrame | None,
    team_stats: DataFrame,
    first_play_season: int = config.PLAYS_FIRST_SEASON,
) -> DataFrame:
    """Twelve metrics for every (team, season, week > 3).

    A season from ``first_play_season`` on that has plays is computed from
    them, for the regular-season weeks a team played; any other season, and all
    of them where there is no play feed (None), gets the default of every
    metric for its team rows.
    """
    constants = team_stats.select(
        "team", "season", "week", F.lit(True).alias("eligible"), F.lit(0).alias("path"),
        *[F.lit(v).alias(m) for m, v in config.TEAM_METRICS.items()],
    )
    if plays is None:
        return constants.filter(F.col("week") > 3).select("team", "season", "week", *config.TEAM_METRICS)
    weekly = _both_sides(plays.filter(F.col("season") >= first_play_season))
    columns = [c for c in weekly.columns if c not in ("team", "season", "week")]
    # every week counts for the three after it (k = 1..3) and marks itself (k = 0)
    marked = weekly.withColumn(
        "k", F.explode(F.array(*[F.lit(k) for k in range(config.TEAM_LOOKBACK_WEEKS + 1)]))
    ).withColumn("target_week", F.col("week") + F.col("k"))
    from_plays = (
        marked.groupBy("team", "season", F.col("target_week").alias("week"))
        .agg(
            F.expr("count_if(k = 0) AS played"),
            F.expr("coalesce(sum(reg_plays) FILTER (WHERE k = 0), 0) > 0 AS eligible"),
            *[F.expr(f"sum({c}) FILTER (WHERE k > 0) AS {c}") for c in columns],
        )
        .filter(F.col("played") > 0)
        .select("team", "season", "week", "eligible", F.lit(1).alias("path"), *_metrics(config.TEAM_METRICS))
    )
    # both paths are sized by teams x weeks, so a window per season stays small
    best = F.max("path").over(Window.partitionBy("season"))
    both = from_plays.unionByName(constants).withColumn("best", best)
    chosen = both.filter((F.col("path") == F.col("best")) & F.col("eligible") & (F.col("week") > 3))
    return chosen.select("team", "season", "week", *config.TEAM_METRICS)
