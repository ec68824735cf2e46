"""Context of a game: rest, home/away form, history and opponent strength."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.scalars import existing, null_safe_sum
from weekfold.operators.joins import earlier_totals, last_meetings, since_last_season, team_games
from weekfold.operators.windows import rank_in_period

KEY = ["player_id", "season", "week"]


def total_yards(df: DataFrame) -> Column:
    return null_safe_sum(*existing(df, ["passing_yards", "rushing_yards", "receiving_yards"]))


def touchdowns(df: DataFrame) -> Column:
    return null_safe_sum(*existing(df, ["passing_tds", "rushing_tds", "receiving_tds"]))


def with_game(stats: DataFrame, schedule: DataFrame) -> DataFrame:
    """Role, rest days and division flag of each player row; null without a game."""
    games = team_games(schedule).select(
        "team", "season", "week", "game_role",
        F.coalesce("rest", F.lit(config.DEFAULT_REST_DAYS)).alias("rest_days"),
        F.coalesce(F.col("div_game").cast("boolean"), F.lit(False)).alias("divisional_game"),
    )
    return stats.join(games, ["team", "season", "week"], "left")


def with_splits(placed: DataFrame) -> DataFrame:
    """Games, mean fantasy points and mean yards at home and away, strictly before."""
    yards = total_yards(placed)
    measures = {}
    for role in ("home", "away"):
        here = F.col("game_role") == role
        measures[f"{role}_games"] = F.count(F.when(here, F.lit(1)))
        measures[f"{role}_avg_fantasy_points"] = F.avg(F.when(here, F.col("fantasy_points")))
        measures[f"{role}_avg_yards"] = F.avg(F.when(here, yards))
    seen = earlier_totals(placed, ["player_id"], measures)
    return seen.withColumns({m: F.coalesce(m, F.lit(0)) for m in measures})


def with_history(stats: DataFrame, n: int = config.HISTORY_MEETINGS) -> DataFrame:
    """The last meetings with the opponent of this week, newest first."""
    fields = {
        "season": F.col("season"), "week": F.col("week"),
        "fantasy_points": F.coalesce("fantasy_points", F.lit(0.0)),
        "total_yards": total_yards(stats), "touchdowns": touchdowns(stats),
    }
    return last_meetings(stats, ["player_id", "opponent_team"], fields, n, "opp_history")


def defence_ranks(stats: DataFrame, team_stats: DataFrame, positions=tuple(config.RANK_METRIC)) -> DataFrame:
    """Rank of every defence in every week against every position.

    The position is a grouping key: all of them come from one scan of the
    statistics. A defence nobody of the position met counts as 0 allowed.
    """
    metric = F
    for p, m in config.RANK_METRIC.items():
        if m in stats.columns:
            metric = metric.when(F.col("position") == p, F.coalesce(m, F.lit(0)))
    faced = stats.select(
        F.col("opponent_team").alias("team"), "season", "week", "position",
        metric.otherwise(F.lit(None)).cast("double").alias("v"),
    ).groupBy("team", "season", "week", "position").agg(F.avg("v").alias("v"))
    grid = team_stats.select("team", "season", "week").distinct().withColumn(
        "position", F.explode(F.array(*[F.lit(p) for p in positions]))
    )
    allowed = grid.join(faced, ["team", "season", "week", "position"], "left").select(
        "team", "season", "week", "position", F.coalesce("v", F.lit(0.0)).alias("avg_allowed")
    )
    # sums of doubles differ in the last bits between runs; ties must not
    stable = F.round("avg_allowed", 9)
    return rank_in_period(allowed, stable, ("season", "week", "position"), "defense_rank")


def allowed_stats(stats: DataFrame) -> dict[str, list[str]]:
    """The statistics kept per position: the first ten configured that exist."""
    return {
        p: existing(stats, config.position_stats(p)[: config.ALLOWED_STATS])
        for p in config.POSITION_STATS
    }


def defence_allowed(stats: DataFrame) -> DataFrame:
    """Mean statistics a defence allowed to a position before each week.

    Statistics are summed per (opponent, position, season, week) first; the
    look-back then runs over that table, which is sized by the calendar.
    """
    per_position = allowed_stats(stats)
    union = list(dict.fromkeys(s for names in per_position.values() for s in names))
    group = ["opponent_team", "position"]
    weekly = stats.groupBy(*group, "season", "week").agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *[F.expr(f"sum(coalesce(cast(`{s}` AS double), 0D)) AS `{s}`") for s in union],
    )
    totals = since_last_season(weekly, group, ["_n", *union])

    def means(names) -> str:
        pairs = ", ".join(f"'{s}', if(_n > 0, `{s}` / _n, 0D)" for s in names)
        return f"map({pairs})"

    cases = " ".join(f"WHEN '{p}' THEN {means(n)}" for p, n in per_position.items() if n)
    packed = F.expr(f"CASE position {cases} END")
    return totals.select(*group, "season", "week", packed.alias("opp_allowed"))


def with_opponent(df: DataFrame, stats: DataFrame, team_stats: DataFrame) -> DataFrame:
    """Rank of, and means allowed by, the opponent against the player's position."""
    on = ["opponent_team", "season", "week", "position"]
    ranks = defence_ranks(stats, team_stats).select(
        F.col("team").alias("opponent_team"), "season", "week", "position",
        F.col("defense_rank").alias("_rank"),
    )
    # both sides are sized by the calendar: joined first, then once to the players
    strength = ranks.join(defence_allowed(stats), on, "full")
    return df.join(strength, on, "left").withColumn(
        "opp_rank_vs_position", F.coalesce("_rank", F.lit(config.DEFAULT_OPPONENT_RANK))
    ).drop("_rank")


CONTEXT = (
    "rest_days", "divisional_game",
    "home_games", "away_games", "home_avg_fantasy_points", "away_avg_fantasy_points",
    "home_avg_yards", "away_avg_yards",
    "opp_history", "opp_rank_vs_position", "opp_allowed",
)


def context(stats: DataFrame, schedule: DataFrame, team_stats: DataFrame) -> DataFrame:
    """All matchup columns of every player row.

    The two windows share one exchange by player: the history window clusters
    on (player, opponent), which a partitioning by player already satisfies.
    """
    placed = with_history(with_splits(with_game(stats, schedule)))
    return with_opponent(placed, stats, team_stats).select(*KEY, *CONTEXT)


def matchup(features: DataFrame, stats: DataFrame, schedule: DataFrame, team_stats: DataFrame) -> DataFrame:
    """Features with the matchup columns of their own player and period."""
    return features.join(context(stats, schedule, team_stats), KEY, "left")


def matchup_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("rest_days").alias("with_rest_days"),
        F.count("divisional_game").alias("with_divisional"),
        F.count("home_games").alias("with_splits"),
        F.count("opp_history").alias("with_opp_history"),
        F.count("opp_rank_vs_position").alias("with_opp_rank"),
        F.count("opp_allowed").alias("with_opp_stats"),
        F.avg(F.col("divisional_game").cast("int")).alias("pct_divisional"),
        F.avg("rest_days").alias("avg_rest_days"),
    )
