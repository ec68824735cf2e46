"""Entity spans, weekly snapshots and experience bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold.functions.nested import merge_lists
from weekfold.functions.scalars import (
    experience_band,
    experience_confidence,
    experience_strategy,
    seasons_played,
    snapshot_key,
)
from weekfold.operators.joins import team_games

MEMBER_FIELDS = {
    "gsis_id": "gsis_id", "name": "full_name", "position": "position",
    "depth_position": "depth_chart_position", "jersey_number": "jersey_number",
    "status": "status", "years_exp": "years_exp", "height": "height", "weight": "weight",
}
ON_ROSTER = ("ACT", "RES")


def span(df: DataFrame, entity: str) -> DataFrame:
    """First and last season of each entity."""
    return df.groupBy(entity).agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season")
    )


def career(df: DataFrame, entity: str, prefix: str) -> DataFrame:
    """Span and sorted distinct teams of each entity."""
    known = df.dropna(subset=[entity, "season", "team"])
    return known.groupBy(entity).agg(
        F.min("season").alias(f"{prefix}_first"),
        F.max("season").alias(f"{prefix}_last"),
        F.array_sort(F.collect_set("team")).alias(f"{prefix}_teams"),
    )


def lifecycle(players: DataFrame, rosters: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per player: career span, teams, position, status.

    Roster spans win over spans seen in the statistics; team lists are merged.
    A player marked RET is retired; one last seen before the season preceding
    the newest is inactive; everyone else, also the never seen, is active.
    """
    from_rosters = career(rosters, "gsis_id", "r").withColumnRenamed("gsis_id", "_gsis")
    from_stats = career(stats, "player_id", "s").withColumnRenamed("player_id", "_player")
    newest = stats.agg(F.max("season")).scalar()
    last = F.coalesce("r_last", "s_last")
    status = (
        F.when(F.col("status") == "RET", F.lit("retired"))
        .when(last < newest - 1, F.lit("inactive"))
        .otherwise(F.lit("active"))
    )
    return (
        players.dropna(subset=["player_id"])
        .join(from_rosters, F.col("gsis_id") == F.col("_gsis"), "left")
        .join(from_stats, F.col("player_id") == F.col("_player"), "left")
        .select(
            "player_id", "gsis_id", "espn_id",
            F.coalesce("r_first", "s_first").alias("first_season"),
            last.alias("last_season"),
            merge_lists("r_teams", "s_teams").alias("career_teams"),
            F.coalesce("position_group", "position").alias("primary_position"),
            "draft_year", "draft_round", "draft_pick", "college",
            status.alias("status"),
        )
    )


def lifecycle_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_players"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("active", "retired", "inactive")],
        F.min("first_season").alias("earliest_season"),
        F.max("last_season").alias("latest_season"),
    )


def pack(df: DataFrame, keys, fields, name: str) -> DataFrame:
    """Sorted list of structs per key. ``fields`` is a list or {name: column}.

    For lists whose length is bounded by the calendar or the rules of the game;
    the first field should identify the member.
    """
    named = fields if isinstance(fields, dict) else {f: f for f in fields}
    member = F.struct(*[F.col(c).alias(n) for n, c in named.items()])
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias(name))


def roster_changes(rosters: DataFrame) -> DataFrame:
    """Members who joined or left each (team, season, week) against the week before.

    One grouping per member decides both directions: every membership row also
    marks the week after as "was here", and a week with only one of the two
    marks is a change. No pair of rosters is ever compared member by member.
    """
    seen = rosters.select(
        "team", "season", "gsis_id",
        F.explode(F.array(
            F.struct(F.col("week").alias("week"), F.lit(1).alias("now"), F.lit(0).alias("prev")),
            F.struct((F.col("week") + 1).alias("week"), F.lit(0).alias("now"), F.lit(1).alias("prev")),
        )).alias("m"),
    ).select("team", "season", "gsis_id", "m.*")
    marks = seen.groupBy("team", "season", "week", "gsis_id").agg(
        F.max("now").alias("now"), F.max("prev").alias("prev")
    )
    changed = marks.filter(F.col("now") != F.col("prev")).select(
        "team", "season", "week", "gsis_id", (F.col("now") == 1).alias("joined")
    )
    return changed


def snapshot_members(rosters: DataFrame) -> DataFrame:
    """One row per member on a roster in a week (status ACT or RES)."""
    base = rosters.dropna(subset=["gsis_id", "team", "season", "week"])
    return base.filter(F.col("status").isin(*ON_ROSTER)).select(
        snapshot_key().alias("snapshot_id"), "team", "season", "week",
        *[F.col(c).alias(n) for n, c in MEMBER_FIELDS.items()],
    )


def snapshot_depth(depth: DataFrame) -> DataFrame:
    """One row per depth-chart entry of a team and week."""
    named = depth.dropna(subset=["gsis_id", "club_code", "season", "week"])
    return named.select(
        snapshot_key("club_code").alias("snapshot_id"),
        F.col("club_code").alias("team"), "season", "week",
        "gsis_id", "position", "formation", "depth_team",
        F.concat("first_name", F.lit(" "), "last_name").alias("name"),
    )


def snapshot_index(rosters: DataFrame, schedule: DataFrame, depth: DataFrame) -> DataFrame:
    """One row per snapshot: date, and how many members, entries and changes it has.

    Members, depth entries and changes stay in their own long tables keyed by
    the snapshot; this is their header, and is sized by teams x weeks.
    """
    keys = ["team", "season", "week"]
    base = rosters.dropna(subset=["gsis_id", *keys])
    n = F.count(F.lit(1))
    heads = snapshot_members(rosters).groupBy(*keys).agg(n.alias("members"))
    dates = team_games(schedule).groupBy(*keys).agg(F.min("gameday").alias("snapshot_date"))
    entries = snapshot_depth(depth).groupBy(*keys).agg(n.alias("depth_entries"))
    changes = roster_changes(base).groupBy(*keys).agg(
        F.count_if("joined").alias("new_players"), F.count_if(~F.col("joined")).alias("removed_players")
    )
    zero = F.lit(0).cast("bigint")
    return (
        heads.join(dates, keys, "left").join(entries, keys, "left").join(changes, keys, "left")
        .select(
            snapshot_key().alias("snapshot_id"), *keys, "snapshot_date", "members",
            *[F.coalesce(c, zero).alias(c) for c in ("depth_entries", "new_players", "removed_players")],
        )
    )


def snapshots(rosters: DataFrame, schedule: DataFrame, depth: DataFrame) -> DataFrame:
    """Snapshots with members, depth chart and changes packed as lists.

    The lists of a team-week are as long as the rules of the game let a roster
    be; the long tables behind ``snapshot_index`` hold the same rows unpacked.
    """
    keys = ["team", "season", "week"]
    base = rosters.dropna(subset=["gsis_id", *keys])
    members = pack(snapshot_members(rosters), keys, list(MEMBER_FIELDS), "members")
    dates = team_games(schedule).groupBy(*keys).agg(F.min("gameday").alias("snapshot_date"))
    chart = pack(
        snapshot_depth(depth), keys,
        ["gsis_id", "position", "formation", "depth_team", "name"], "depth_chart",
    )
    changes = roster_changes(base).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("joined"), F.col("gsis_id")))).alias("new_players"),
        F.array_sort(F.collect_list(F.when(~F.col("joined"), F.col("gsis_id")))).alias("removed_players"),
    )
    ids = f"array<{dict(rosters.dtypes)['gsis_id']}>"

    def or_empty(name: str, kind: str) -> Column:
        return F.coalesce(name, F.array().cast(kind)).alias(name)

    return (
        members.join(dates, keys, "left").join(chart, keys, "left").join(changes, keys, "left")
        .select(
            snapshot_key().alias("snapshot_id"), *keys, "snapshot_date", "members",
            or_empty("depth_chart", dict(chart.dtypes)["depth_chart"]),
            or_empty("new_players", ids), or_empty("removed_players", ids),
            F.array().cast(ids).alias("position_changes"),
        )
    )


def experience(stats: DataFrame, lifecycles: DataFrame) -> DataFrame:
    """Experience band of every player-season."""
    first = lifecycles.select("player_id", "first_season").dropna()
    seasons = stats.dropna(subset=["player_id", "season"]).select("player_id", "season").distinct()
    played = seasons_played()
    return seasons.join(first, "player_id").select(
        "player_id", "season",
        experience_band(played).alias("category"),
        played.alias("seasons_played"),
        experience_strategy(played).alias("strategy"),
        experience_confidence(played).alias("confidence"),
    )
