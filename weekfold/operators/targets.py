"""What really happened: prediction targets per position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.nested import append_flag
from weekfold.functions.scalars import safe_divide, win_share
from weekfold.operators.joins import team_games

KEY = ["player_id", "season", "week"]


def _value(df: DataFrame, name: str, ppr_from: str) -> Column:
    source = ppr_from if name == "fantasy_points_ppr" else name
    if source not in df.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(source).cast("double"), F.lit(0.0))


def outcomes(df: DataFrame, ppr_from: str = "fantasy_points_ppr") -> Column:
    """Map of outcome name to value, with the entries of the row's position."""
    def entries(position: str) -> Column:
        spec = config.OUTCOMES[position]
        values = {s: _value(df, s, ppr_from) for s in spec["stats"]}
        values |= {
            name: safe_divide(over, under, 0.0)
            for name, over, under in spec["rates"]
            if over in df.columns and under in df.columns
        }
        if position == "K" and {"fg_made", "pat_made"} <= set(df.columns):
            kicked = F.col("fg_made") * F.lit(3.0) + F.col("pat_made")
            values["fantasy_points_standard"] = F.coalesce(kicked.cast("double"), F.lit(0.0))
        values |= {"team_points": F.col("team_points").cast("double"), "team_won": F.col("team_won")}
        return F.map_from_arrays(
            F.array(*[F.lit(n) for n in values]), F.array(*values.values())
        )

    out = F
    for position in config.OUTCOMES:
        out = out.when(F.col("_position") == position, entries(position))
    return out.otherwise(F.lit(None))


def primary_target(position: Column) -> Column:
    out = F
    for p, name in config.PRIMARY_TARGET.items():
        out = out.when(position == p, F.lit(name))
    return out.otherwise(F.lit(config.DEFAULT_PRIMARY_TARGET))


def targets(
    features: DataFrame, stats: DataFrame, schedule: DataFrame, ppr_from: str = "fantasy_points_ppr"
) -> DataFrame:
    """Outcomes and primary target of every feature row, from its own week."""
    wanted = {s for spec in config.OUTCOMES.values() for s in spec["stats"]}
    wanted |= {c for spec in config.OUTCOMES.values() for r in spec["rates"] for c in r[1:]}
    wanted |= {"fg_made", "pat_made", ppr_from}
    have = [c for c in stats.columns if c in wanted]
    games = (
        team_games(schedule).filter(F.col("game_type") == "REG")
        .select(
            "team", "season", "week", F.col("points").alias("team_points"),
            win_share("points", "points_against").alias("team_won"),
        )
    )
    actual = stats.select(*KEY, "team", *have).join(games, ["team", "season", "week"], "left").drop("team")
    rows = features.select(
        "feature_id", F.col("entity_id").alias("player_id"), "season", "week",
        F.col("position").alias("_position"),
    )
    joined = rows.join(actual, KEY, "left")
    return joined.select(
        "feature_id", outcomes(joined, ppr_from).alias("outcomes"),
        primary_target(F.col("_position")).alias("prediction_target"),
    )


def with_targets(features: DataFrame, found: DataFrame) -> DataFrame:
    """Attach targets; rows left without outcomes get the flag ``no_target_data``."""
    joined = features.join(found, "feature_id", "left")
    if "flags" not in joined.columns:
        joined = joined.withColumn("flags", F.array().cast("array<string>"))
    return joined.withColumn("flags", append_flag("flags", "no_target_data", F.col("outcomes").isNull()))


def target_summary(df: DataFrame, group: str = "position") -> DataFrame:
    """Rows, rows with outcomes and mean fantasy points per group."""
    points = F.coalesce(
        F.element_at("outcomes", "fantasy_points_ppr"),
        F.element_at("outcomes", "fantasy_points_standard"), F.lit(0.0),
    )
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total"), F.count("outcomes").alias("with_targets"),
        F.avg(points).alias("avg_fantasy_points"),
    )

