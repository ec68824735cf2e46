"""Point-in-time feature vectors: everything known before a game, in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions import scalars as fx
from weekfold.operators.joins import lag_period, team_games
from weekfold.operators.windows import column_name

KEY = ["player_id", "season", "week"]
TARGET_WEEK_FIELDS = ("opp_rank_vs_position", "rest_days", "divisional_game")


def vector_stats() -> list[str]:
    """Every statistic some position's vector reads."""
    return list(dict.fromkeys(s for slots in config.VECTOR_STATS.values() for s, _ in slots if s))


def _known(columns, name: str | None) -> str:
    return f"coalesce(cast(`{name}` AS double), 0D)" if name in columns else "0D"


def _by_position(build, other: str) -> str:
    cases = " ".join(f"WHEN '{p}' THEN {build(p)}" for p in config.VECTOR_STATS)
    return f"CASE position {cases} ELSE {other} END"


def numerical_vector(df: DataFrame) -> Column:
    """17 shared values, then ten per window chosen by position; nulls are 0."""
    columns = set(df.columns)
    shared = ", ".join(_known(columns, n) for n in config.VECTOR_UNIVERSAL)

    def window(n: int) -> str:
        def slots(p: str) -> str:
            names = [column_name(s, "avg", n) if s else None for s, _ in config.VECTOR_STATS[p]]
            return "array(" + ", ".join(_known(columns, c) for c in names) + ")"

        return _by_position(slots, "array_repeat(0D, 10)")

    windows = ", ".join(window(n) for n in config.VECTOR_WINDOWS.values())
    return F.expr(f"concat(array({shared}), {windows})")


def vector_labels() -> Column:
    def names(p: str) -> str:
        return "array(" + ", ".join(f"'{n}'" for n in config.vector_names(p)) + ")"

    return F.expr(_by_position(names, "cast(NULL AS array<string>)"))


def assemble(
    stats: DataFrame,
    schedule: DataFrame,
    player_features: DataFrame,
    team_features: DataFrame,
    experience: DataFrame,
    matchup_alignment: str = "lagged",
    positions=config.VECTOR_POSITIONS,
) -> DataFrame:
    """One row per player and week > 1 whose previous week has features.

    Player, team and opponent features are those of the week before, joined on
    the exact week. ``matchup_alignment="target"`` takes opponent rank, rest
    and division from the week itself instead; the schedule tells them ahead.
    """
    context = stats.filter(F.col("week") > 1).select(*KEY, "team", "opponent_team").distinct()
    drop = {"player_name", "team", "game_number"}
    lagged = lag_period(player_features.drop(*drop)).filter(F.col("position").isin(*positions))
    if matchup_alignment == "target":
        known = [c for c in TARGET_WEEK_FIELDS if c in player_features.columns]
        own_week = player_features.select(*KEY, *known)
        lagged = lagged.drop(*known).join(own_week, KEY, "left")
    elif matchup_alignment != "lagged":
        raise ValueError(f"unknown alignment {matchup_alignment}")

    games = (
        team_games(schedule).filter(F.col("game_type") == "REG")
        .select("team", "season", "week", F.col("gameday").alias("game_date"), "game_role")
    )
    own = lag_period(team_features)
    defence = [m for m in config.TEAM_METRICS if m.startswith("def_")]
    rival = own.select(
        F.col("team").alias("opponent_team"), "season", "week",
        *[F.col(m).alias(f"opp_{m}") for m in defence],
    )
    bands = experience.select("player_id", "season", F.col("category").alias("experience"))
    joined = (
        context.join(lagged, KEY)
        .join(bands, ["player_id", "season"], "left")
        .join(games, ["team", "season", "week"], "left")
        .join(own, ["team", "season", "week"], "left")
        .join(rival, ["opponent_team", "season", "week"], "left")
    )
    role = F.coalesce("game_role", F.lit("neutral"))
    return joined.select(
        fx.feature_key().alias("feature_id"),
        F.lit("player").alias("entity_type"),
        F.col("player_id").alias("entity_id"),
        "season", "week", "game_date", "position", "team", "opponent_team", "experience",
        numerical_vector(joined).alias("numerical"),
        vector_labels().alias("names"),
        F.struct(
            fx.encode_position().alias("position"),
            F.struct(F.col("team").alias("value")).alias("team"),
            F.struct(F.col("opponent_team").alias("value")).alias("opponent"),
            fx.encode_role(role).alias("home_away"),
            fx.encode_flag("divisional_game").alias("divisional_game"),
            fx.encode_experience("experience").alias("experience_level"),
        ).alias("categorical"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("position").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("numerical")).alias("avg_features")
    )
