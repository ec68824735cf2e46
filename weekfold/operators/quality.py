"""Completeness, outlier and consistency checks; the row quality score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.nested import count_matching, set_flags
from weekfold.functions.scalars import as_col, stepped, weeks_ago, z_score
from weekfold.operators.joins import with_one_row


# --- audits ---------------------------------------------------------------------
def distinct_per_group(df: DataFrame, group, *columns: str, within: float | None = None) -> DataFrame:
    """Exact distinct counts per group, each reduced to its pairs first.

    ``within`` asks for estimates with that relative deviation instead, from
    sketches of fixed size: no value is shuffled.

    Every column becomes a (group, value) de-duplication with map-side combine
    and then a plain count, so a dominant group never reaches one task raw.
    """
    group = list(group)
    if within is not None:
        return df.groupBy(*group).agg(*[F.approx_count_distinct(c, within).alias(c) for c in columns])
    counted = [
        df.select(*group, c).distinct().groupBy(*group).agg(F.count(c).alias(c)) for c in columns
    ]
    if not group:
        return reduce(with_one_row, counted)
    return reduce(lambda a, b: a.join(b, group), counted)


def null_audit(df: DataFrame, column: str, group=()) -> DataFrame:
    total, filled = F.count(F.lit(1)), F.count(column)
    return df.groupBy(*group).agg(
        total.alias("total"), filled.alias("filled"), (total - filled).alias("missing"),
        (filled * 100.0 / total).alias("pct"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """Rows, distinct players and seasons, and the season range."""
    per_player = df.groupBy("player_id", "season").agg(F.count(F.lit(1)).alias("n"))
    seasons = per_player.groupBy("season").agg(F.sum("n").alias("n"))
    totals = seasons.agg(
        F.sum("n").alias("total_records"), F.count("season").alias("seasons_covered"),
        F.min("season").alias("earliest_season"), F.max("season").alias("latest_season"),
    )
    players = per_player.select("player_id").distinct().agg(F.count("player_id").alias("unique_players"))
    return with_one_row(totals, players)


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0, limit: int = 100, tiebreak=()) -> DataFrame:
    """Rows more than ``threshold`` deviations from the mean, furthest first."""
    known = df.filter(F.col(column).isNotNull())
    stats = known.agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std"))
    scored = with_one_row(known, stats).withColumn("z_score", z_score(column, "_mean", "_std"))
    return (
        scored.filter(F.col("z_score") > threshold).drop("_mean", "_std")
        .orderBy(F.desc("z_score"), *tiebreak).limit(limit)
    )


def validate_team(df: DataFrame) -> DataFrame:
    """Out-of-range counts and a summary of the team metrics, in one pass."""
    def outside(lo, hi, *names):
        return reduce(lambda a, b: a | b, [(F.col(c) < lo) | (F.col(c) > hi) for c in names])

    epa = ("off_epa_per_play_last3", "def_epa_per_play_last3")
    rates = ("off_success_rate_last3", "def_success_rate_last3")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(outside(-3, 3, *epa)).alias("invalid_epa"),
        F.count_if(outside(0, 1, *rates)).alias("invalid_success"),
        F.count_if(F.col(epa[0]).isNull() | F.col(epa[1]).isNull()).alias("null_epa"),
        F.count_distinct("team").alias("unique_teams"),
        F.count_distinct("season").alias("seasons"),
        F.min("season").alias("earliest_season"), F.max("season").alias("latest_season"),
        F.avg(epa[0]).alias("avg_off_epa"), F.avg(epa[1]).alias("avg_def_epa"),
    )


def _violations(df: DataFrame, checks: dict[str, Column], duplicate_of=()) -> DataFrame:
    """Violation count per rule as rows; duplicates counted from per-key sizes."""
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    wide = counted
    if duplicate_of:
        sizes = df.groupBy(*duplicate_of).agg(F.count(F.lit(1)).alias("n"))
        dups = sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))
        wide = with_one_row(wide, dups)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("violations"))
        for c in wide.columns
    ])).alias("v")).select("v.*")


def validate_lifecycle(df: DataFrame) -> DataFrame:
    return _violations(df, {
        "null_player_id": F.col("player_id").isNull(),
        "span_reversed": F.col("last_season") < F.col("first_season"),
        "season_out_of_range": ~F.col("first_season").between(1990, 2030)
        | ~F.col("last_season").between(1990, 2030),
    }, ["player_id"])


def validate_snapshots(df: DataFrame, max_team_length: int = 3, last_week: int = 22) -> DataFrame:
    return _violations(df, {
        "bad_team_code": ~F.length(F.col("team").cast("string")).between(1, max_team_length),
        "week_out_of_range": ~F.col("week").between(1, last_week),
        "no_members": F.col("members") < 1,
    }, ["snapshot_id"])


def validate_experience(df: DataFrame) -> DataFrame:
    bands = list(config.EXPERIENCE)
    strategies = [v[1] for v in config.EXPERIENCE.values()]
    played = F.col("seasons_played")
    band = F.when(played <= 1, bands[0]).when(played <= 3, bands[1]).otherwise(bands[2])
    return _violations(df, {
        "unknown_category": ~F.col("category").isin(*bands),
        "unknown_strategy": ~F.col("strategy").isin(*strategies),
        "played_below_one": played < 1,
        "confidence_out_of_range": ~F.col("confidence").between(0.0, 1.0),
        "band_mismatch": F.col("category") != band,
    }, ["player_id", "season"])


def check_feature_json(df: DataFrame, document: str, group: str = "position") -> DataFrame:
    """Documents lacking a required key or any statistic, per position."""
    keys = F.json_object_keys(document)
    required = F.array_contains(keys, "window_size") & F.array_contains(keys, "games_in_window")
    stats = F.size(keys) > 2
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.coalesce(required, F.lit(False))).alias("missing_keys"),
        F.count_if(~F.coalesce(stats, F.lit(False))).alias("without_stats"),
    )


def check_inputs(frames: dict[str, DataFrame | None], required) -> list[str]:
    """Raise if a required table is absent; return the names of empty ones."""
    missing = [n for n in required if frames.get(n) is None]
    if missing:
        raise ValueError(f"missing required tables: {missing}")
    return [n for n in required if frames[n].isEmpty()]


def input_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count and emptiness of each input as rows."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty")
        )
        for n, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# --- the row score ---------------------------------------------------------------
def completeness_ratio(vector) -> Column:
    vector = as_col(vector)
    return count_matching(vector, lambda x: x != 0.0) / F.nullif(F.size(vector), F.lit(0))


def completeness_score(vector) -> Column:
    return stepped(completeness_ratio(vector), config.COMPLETENESS_STEPS, 0.0, at_least=True)


def extreme_values(vector) -> Column:
    return count_matching(vector, lambda x: F.abs(x) > config.EXTREME_VALUE)


def outlier_score(vector) -> Column:
    return stepped(extreme_values(vector), config.OUTLIER_STEPS, 0.0, at_least=False)


def recency_score(age: Column) -> Column:
    return stepped(age, config.RECENCY_STEPS, 0.5, at_least=False)


def critical_gate(*fields) -> Column:
    present = reduce(lambda a, b: a & b, [as_col(f).isNotNull() for f in fields])
    return F.when(present, F.lit(1.0)).otherwise(F.lit(0.0))


def score_quality(
    df: DataFrame,
    vector: str = "numerical",
    position: str = "position",
    team: str = "team",
    opponent: str = "opponent_team",
) -> DataFrame:
    """Add ``quality``, its parts, and ``flags``: one projection, no joins.

    The newest season and week (independent maxima) are scalar subqueries.
    """
    newest = df.agg(F.max("season").alias("_s"), F.max("week").alias("_w"))
    w = config.QUALITY_WEIGHTS
    age = weeks_ago("season", "week", "_s", "_w")
    parts = with_one_row(df, newest).select(
        *df.columns,
        completeness_ratio(vector).alias("completeness_ratio"),
        completeness_score(vector).alias("completeness_score"),
        extreme_values(vector).alias("extreme_values"),
        outlier_score(vector).alias("outlier_score"),
        age.alias("weeks_ago"),
        recency_score(age).alias("recency_score"),
        critical_gate(position, team, opponent, "season", "week").alias("critical"),
    )
    score = (
        F.col("completeness_score") * w["completeness"]
        + F.col("outlier_score") * w["outlier"]
        + F.col("recency_score") * w["recency"]
    ) * F.col("critical")
    return parts.select(
        "*", score.alias("quality"),
        set_flags({
            "low_completeness": F.col("completeness_ratio") < 0.5,
            "high_outliers": F.col("extreme_values") > 5,
            "missing_position": F.col(position).isNull(),
            "missing_team": F.col(team).isNull(),
            "missing_opponent": F.col(opponent).isNull(),
            "stale_data": F.col("weeks_ago") > 35,
        }).alias("flags"),
    )


def passing(df: DataFrame, min_score: float = config.MIN_QUALITY) -> DataFrame:
    """Drop rows below the score; an unknown score is kept."""
    return df.filter(F.coalesce(F.col("quality") >= min_score, F.lit(True)))


def quality_summary(df: DataFrame, min_score: float = config.MIN_QUALITY) -> DataFrame:
    """scored = passed + filtered."""
    total = F.count(F.lit(1))
    failed = F.count_if(F.col("quality") < min_score)
    return df.agg(
        total.alias("scored"), (total - failed).alias("passed"), failed.alias("filtered"),
        F.avg("quality").alias("avg_score"), F.min("quality").alias("min_score"),
        F.max("quality").alias("max_score"),
    )
