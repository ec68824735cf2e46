"""Column helpers: pure expressions that stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- time --------------------------------------------------------------------
def ordinal(season: ColumnLike = "season", week: ColumnLike = "week") -> Column:
    """One sortable number per period, so a compound time test is one ``<``."""
    return as_col(season) * config.PERIOD_WEIGHT + as_col(week)


def before(season: int, week: int, season_col: ColumnLike = "season", week_col: ColumnLike = "week") -> Column:
    """Strictly earlier than (season, week).

    Written as a season bound plus the ordinal test: the first conjunct reaches
    the scan as a pushed filter and prunes season partitions.
    """
    return (as_col(season_col) <= season) & (
        ordinal(season_col, week_col) < season * config.PERIOD_WEIGHT + week
    )


def weeks_ago(season: ColumnLike, week: ColumnLike, last_season: ColumnLike, last_week: ColumnLike) -> Column:
    return (as_col(last_season) - as_col(season)) * config.WEEKS_PER_SEASON + (
        as_col(last_week) - as_col(week)
    )


def parse_period(df: DataFrame, ts_col: str = "dt", fmt: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> DataFrame:
    """Text timestamp -> ``dt_timestamp`` and season ``week``.

    Months up to August count as week 1; later days count in sevens from day
    244 of the year, truncated. Text that does not parse keeps a null timestamp
    and week 1.
    """
    parsed = F.try_to_timestamp(F.col(ts_col), F.lit(fmt))
    late = ((F.dayofyear(parsed) - 244) / 7 + 1).cast("int")
    week = F.when(parsed.isNull() | (F.month(parsed) <= 8), F.lit(1)).otherwise(late)
    return df.withColumn("dt_timestamp", parsed).withColumn("week", week)


def clock_seconds(text: ColumnLike) -> Column:
    """``"MM:SS"`` -> whole seconds; empty, null or malformed -> null."""
    text = as_col(text)
    minutes = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(F.length(text) > 0, minutes * 60 + seconds)


def clock_minutes(text: ColumnLike) -> Column:
    return clock_seconds(text) / F.lit(60.0)


# --- arithmetic ---------------------------------------------------------------
def safe_divide(over: ColumnLike, under: ColumnLike, default: float | None = None) -> Column:
    """Double division; zero or null divisor gives ``default`` (null if None)."""
    over, under = as_col(over).cast("double"), as_col(under).cast("double")
    ratio = over / F.nullif(under, F.lit(0.0))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def null_safe_sum(*columns: ColumnLike) -> Column:
    """Sum in which a null counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c), F.lit(0)) for c in columns])


def z_score(value: ColumnLike, mean: ColumnLike, std: ColumnLike) -> Column:
    return F.abs(safe_divide(as_col(value) - as_col(mean), std))


def stepped(value: Column, steps, default: float, at_least: bool) -> Column:
    """Score from ordered (bound, score) steps; first matching step wins."""
    out = F
    for bound, score in steps:
        test = value >= bound if at_least else value <= bound
        out = out.when(test, F.lit(score))
    return out.otherwise(F.lit(default))


# --- keys ---------------------------------------------------------------------
def snapshot_key(team: ColumnLike = "team", season: ColumnLike = "season", week: ColumnLike = "week") -> Column:
    return F.concat(
        as_col(team).cast("string"), F.lit("_"), as_col(season).cast("string"),
        F.lit("_W"), as_col(week).cast("string"),
    )


def feature_key(entity: ColumnLike = "player_id", season: ColumnLike = "season", week: ColumnLike = "week") -> Column:
    return F.concat_ws("_", *[as_col(c).cast("string") for c in (entity, season, week)])


# --- categories ---------------------------------------------------------------
def seasons_played(season: ColumnLike = "season", first_season: ColumnLike = "first_season") -> Column:
    return as_col(season) - as_col(first_season) + 1


def _by_band(played: ColumnLike, field: int) -> Column:
    played, out = as_col(played), F
    for name, spec in config.EXPERIENCE.items():
        value = F.lit(name if field < 0 else spec[field])
        if spec[0] is None:
            return out.otherwise(value)
        out = out.when(played <= spec[0], value)


def experience_band(played: ColumnLike) -> Column:
    return _by_band(played, -1)


def experience_strategy(played: ColumnLike) -> Column:
    return _by_band(played, 1)


def experience_confidence(played: ColumnLike) -> Column:
    return _by_band(played, 2)


def coded(value: ColumnLike, codes: dict[str, int], default: int = 0) -> Column:
    """Integer code of a text value; unknown or null gives ``default``."""
    value, out = as_col(value), F
    for text, code in codes.items():
        out = out.when(value == text, F.lit(code))
    return out.otherwise(F.lit(default))


def with_code(value: Column, code: Column) -> Column:
    return F.struct(value.alias("value"), code.alias("encoded"))


def encode_position(position: ColumnLike = "position") -> Column:
    return with_code(as_col(position), coded(position, config.POSITION_CODES))


def encode_flag(flag: ColumnLike) -> Column:
    flag = F.coalesce(as_col(flag), F.lit(False))
    return with_code(flag, flag.cast("int"))


def encode_experience(band: ColumnLike) -> Column:
    band = F.coalesce(as_col(band), F.lit("unknown"))
    return with_code(band, coded(band, {k: v[3] for k, v in config.EXPERIENCE.items()}))


def game_role(team: ColumnLike, home_team: ColumnLike, away_team: ColumnLike) -> Column:
    """``home`` / ``away`` / ``neutral`` seen from ``team``."""
    team = as_col(team)
    return (
        F.when(team == as_col(home_team), F.lit("home"))
        .when(team == as_col(away_team), F.lit("away"))
        .otherwise(F.lit("neutral"))
    )


def encode_role(role: ColumnLike) -> Column:
    return with_code(as_col(role), coded(role, {"home": 1, "away": 0}, -1))


def win_share(points: ColumnLike, against: ColumnLike) -> Column:
    """1 for a win, 0 for a loss, one half for a tie (also when unknown)."""
    return (
        F.when(as_col(points) > as_col(against), F.lit(1.0))
        .when(as_col(points) < as_col(against), F.lit(0.0))
        .otherwise(F.lit(0.5))
    )


def is_offensive(position: ColumnLike = "position") -> Column:
    return F.coalesce(as_col(position).isin(*config.OFFENSIVE_POSITIONS), F.lit(False))


def is_defensive(position: ColumnLike = "position") -> Column:
    return F.coalesce(as_col(position).isin(*config.DEFENSIVE_POSITIONS), F.lit(False))


def position_group(position: ColumnLike = "position") -> Column:
    """Group name of a position, null when it belongs to none."""
    position, out = as_col(position), F
    for group, members in config.POSITION_GROUPS.items():
        out = out.when(position.isin(*members), F.lit(group))
    return out.otherwise(F.lit(None).cast("string"))


def leaks_outcome(name: ColumnLike, words=config.LEAK_WORDS) -> Column:
    """A feature name that mentions an outcome."""
    return as_col(name).rlike("|".join(words))


# --- columns ------------------------------------------------------------------
def existing(df: DataFrame, names) -> list[str]:
    """The configured names the frame really has, in configured order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def require_any(df: DataFrame, names) -> list[str]:
    kept = existing(df, names)
    if not kept:
        raise ValueError(f"none of {list(names)} is a column of the input")
    return kept
