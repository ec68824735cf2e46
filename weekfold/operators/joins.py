"""Joins that would otherwise be written as OR-joins or range self joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.scalars import ordinal


def team_games(schedule: DataFrame, keep=()) -> DataFrame:
    """Schedule in long form: one row per team and game.

    Joining a team row to "the game where it is home or away" then is an equi
    join on (team, season, week).
    """
    have = set(schedule.columns)

    def side(me: str, other: str):
        fields = {
            "team": f"{me}_team", "opponent_team": f"{other}_team", "rest": f"{me}_rest",
            "points": f"{me}_score", "points_against": f"{other}_score",
        }
        return F.struct(
            F.lit(me).alias("game_role"),
            *[F.col(c).alias(n) for n, c in fields.items() if c in have],
        )

    shared = [c for c in ("game_id", "season", "week", "game_type", "gameday", "div_game") if c in have]
    return schedule.select(
        *shared, *[c for c in keep if c not in shared],
        F.explode(F.array(side("home", "away"), side("away", "home"))).alias("g"),
    ).select(*shared, *[c for c in keep if c not in shared], "g.*")


def attach_game(df: DataFrame, schedule: DataFrame, columns, game_type: str | None = None) -> DataFrame:
    """Left join each team row to its game of that week."""
    games = team_games(schedule)
    if game_type is not None:
        games = games.filter(F.col("game_type") == game_type)
    return df.join(games.select("team", "season", "week", *columns), ["team", "season", "week"], "left")


def prefer(df: DataFrame, first: DataFrame, second: DataFrame, on, columns) -> DataFrame:
    """Left join two sources; take each column from the first, else the second."""
    a = first.select(*on, *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = second.select(*on, *[F.col(c).alias(f"_b_{c}") for c in columns])
    joined = df.join(a, list(on), "left").join(b, list(on), "left")
    return joined.select(
        *df.columns, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns]
    )


def earlier_totals(df: DataFrame, entity, measures: dict, order=None) -> DataFrame:
    """Aggregates over all strictly earlier rows of the entity.

    A range frame ending one ordinal before the current row replaces the
    non-equi self join, and rows of the same period never see each other.
    """
    t = order if order is not None else ordinal()
    w = Window.partitionBy(*entity).orderBy(t).rangeBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[agg.over(w).alias(name) for name, agg in measures.items()])


def since_last_season(weekly: DataFrame, group, sums) -> DataFrame:
    """Per (group, season, week): totals over earlier weeks back to the season before.

    ``weekly`` has one row per (group, season, week). The lower bound moves
    with the season, which no single frame expresses: it is the running total
    inside the season plus the whole season before, a range frame of exactly
    one season back. Both windows share one exchange on the group.
    """
    by = ", ".join(group)
    now = f"OVER (PARTITION BY {by}, season ORDER BY week RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    last = f"OVER (PARTITION BY {by} ORDER BY season RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
    return weekly.selectExpr(
        *group, "season", "week",
        *[f"coalesce(sum(`{c}`) {now}, 0) + coalesce(sum(`{c}`) {last}, 0) AS `{c}`" for c in sums],
    )


def lag_period(features: DataFrame, last_week: int = config.WEEKS_PER_SEASON) -> DataFrame:
    """Shift features one week on, ready to be joined to the week they predict."""
    return features.filter(F.col("week") < last_week).withColumn("week", F.col("week") + 1)


def with_prefix(df: DataFrame, prefix: str, columns, rename: dict | None = None) -> DataFrame:
    """Rename the given columns for a second role of the same table."""
    rename = rename or {}
    return df.select(*[
        F.col(c).alias(f"{prefix}{c}" if c in columns else rename.get(c, c)) for c in df.columns
    ])


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate.

    Each is a scalar subquery, so there is no join: Spark evaluates the
    aggregate once and inserts its values as constants.
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def last_meetings(df: DataFrame, keys, fields: dict, n: int = config.HISTORY_MEETINGS, name: str = "history") -> DataFrame:
    """The last ``n`` rows of the same keys from strictly earlier periods, newest first, as a list.

    A range frame on the period yields them without a self join, so rows of one
    period never see each other; it holds the meetings of one pair, as many as
    the calendar has. Rows of one earlier period come in the order of their
    fields. Null when there are none.
    """
    w = Window.partitionBy(*keys).orderBy(ordinal()).rangeBetween(Window.unboundedPreceding, -1)
    entry = F.struct(ordinal().alias("_at"), *[c.alias(f) for f, c in fields.items()])
    newest_first = F.slice(F.sort_array(F.collect_list(entry).over(w), asc=False), 1, n)
    found = F.transform(newest_first, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return df.withColumn(name, found).withColumn(name, F.when(F.size(name) > 0, F.col(name)))


def update_from(df: DataFrame, changes: DataFrame, on, columns) -> DataFrame:
    """Overwrite columns where ``changes`` has a row; its nulls keep the old value."""
    new = changes.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    merged = {
        c: F.coalesce(f"_new_{c}", c) if c in df.columns else F.col(f"_new_{c}") for c in columns
    }
    rest = [c for c in df.columns if c not in columns]
    return df.join(new, list(on), "left").select(*rest, *[v.alias(c) for c, v in merged.items()])


def delete_where(df: DataFrame, condition) -> DataFrame:
    """Rows for which the condition is false or unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def add_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def merge_on_key(frames: list[DataFrame], on) -> DataFrame:
    """Chained one-to-one joins on the same key (one shuffle per input)."""
    return reduce(lambda a, b: a.join(b, list(on)), frames)
