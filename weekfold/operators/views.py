"""Catalog summaries, standing views and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_summary(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count and column list of every table, one row per table."""
    rows = []
    for name, df in frames.items():
        columns = ", ".join(f"{c} {t}" for c, t in df.dtypes)
        rows.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
            F.lit(columns).alias("column_list"),
        ))
    return reduce(DataFrame.unionByName, rows)


def latest_season(df: DataFrame) -> DataFrame:
    """Rows of the last season; the scalar subquery also prunes partitions."""
    return df.filter(F.col("season") == df.agg(F.max("season")).scalar())


def current_players(stats: DataFrame) -> DataFrame:
    return (
        latest_season(stats.filter(F.col("player_id").isNotNull()))
        .groupBy("player_id", "player_name", "position", "team", "season")
        .agg(F.max("week").alias("latest_week"))
    )


def latest_rosters(stats: DataFrame) -> DataFrame:
    """The last season's players per team and position, one row each."""
    return latest_season(stats).select("team", "position", "player_id", "player_name").distinct()


def roster_counts(rosters: DataFrame) -> DataFrame:
    """The header of ``latest_rosters``: how many players each team and position has."""
    return rosters.groupBy("team", "position").agg(F.count(F.lit(1)).alias("player_count"))


def season_summary(stats: DataFrame) -> DataFrame:
    """Distinct players and teams, last week and rows per season.

    Counted in two levels, (season, player) and (season, team) first, so no
    reducer sees raw rows of a dominant season.
    """
    per_player = stats.groupBy("season", "player_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("week").alias("w")
    ).groupBy("season").agg(
        F.count("player_id").alias("players"), F.max("w").alias("max_week"), F.sum("n").alias("rows")
    )
    per_team = stats.select("season", "team").distinct().groupBy("season").agg(
        F.count("team").alias("teams")
    )
    return per_player.join(per_team, "season")


def lookup(df: DataFrame, newest_first: bool = True, **filters) -> DataFrame:
    """Rows matching the filters that were given; ``None`` means not given."""
    for name, value in filters.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df.orderBy(F.desc("season"), F.desc("week")) if newest_first else df


def team_roster(stats: DataFrame, team, season, week=None) -> DataFrame:
    found = lookup(stats, newest_first=False, team=team, season=season, week=week)
    return found.select("player_id", "player_name", "position", "team").distinct()


def position_summary(stats: DataFrame, position, season, value: str = "fantasy_points") -> DataFrame:
    """Games and mean value of every player at a position in a season, best first."""
    return (
        lookup(stats, newest_first=False, position=position, season=season)
        .groupBy("player_id", "player_name", "team", "position")
        .agg(F.count(F.lit(1)).alias("games_played"), F.avg(value).alias(f"avg_{value}"))
        .orderBy(F.desc(f"avg_{value}"), "player_id")
    )
