"""The whole run: raw tables in, stage tables and a checked dataset out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import form, lifecycle, quality, targets, team, temporal
from weekfold.plans import dataset
from weekfold.operators.ingest import incremental_append, key_columns
from weekfold.plans.player import player_features
from weekfold.sources.feeds import load_feeds
from weekfold.sources.sinks import refresh, write_aligned

REQUIRED = ("players", "rosters", "depth", "stats", "schedule", "team_stats")
#: Inputs of a run by the raw table they come from; plays exist from 2022 on only.
RAW_INPUTS = {
    "stats": "raw_player_stats", "plays": "raw_pbp", "schedule": "raw_schedules", "rosters": "raw_rosters_weekly",
    "depth": "raw_depth_charts", "players": "raw_players", "team_stats": "raw_team_stats",
}
RAW_FEEDS = [t.removeprefix("raw_") for t in RAW_INPUTS.values()]


def _nested_as_text(df: DataFrame) -> DataFrame:
    """Nested results as JSON text, the form the feature tables are stored in."""
    return df.withColumns({
        c: F.to_json(c) for c, t in df.dtypes
        if t.startswith(("map<", "struct<")) or (t.startswith("array<struct<"))
    })


def entity_stages(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Lifecycles, experience bands and roster snapshots."""
    lives = refresh(
        lifecycle.lifecycle(tables["players"], tables["rosters"], tables["stats"]), f"{out}/player_lifecycle"
    )
    return {
        "lifecycle": lives,
        "experience": refresh(lifecycle.experience(tables["stats"], lives), f"{out}/experience"),
        "snapshot_index": refresh(
            lifecycle.snapshot_index(tables["rosters"], tables["schedule"], tables["depth"]),
            f"{out}/snapshot_index",
        ),
        "snapshot_depth": refresh(lifecycle.snapshot_depth(tables["depth"]), f"{out}/snapshot_depth"),
        "snapshot_members": refresh(lifecycle.snapshot_members(tables["rosters"]), f"{out}/snapshot_members"),
        "roster_changes": refresh(lifecycle.roster_changes(tables["rosters"]), f"{out}/roster_changes"),
    }


def feature_stages(
    tables: dict[str, DataFrame], out: str, first_play_season: int = config.PLAYS_FIRST_SEASON
) -> dict[str, DataFrame]:
    """Rolling player form with matchup context, the form of all statistics, and team form.

    ``player_rolling`` has in columns what the vectors read; ``player_form`` has
    every configured statistic, window and measure, a row for each statistic.
    """
    wanted = list(dict.fromkeys([*dataset.vector_stats(), *form.trend_stats()]))
    players = player_features(
        tables["stats"], tables["schedule"], tables["team_stats"], wanted, measures=("avg",), trends_only=True
    )
    return {
        "player_rolling": refresh(players, f"{out}/player_rolling"),
        "player_form": refresh(form.rolling_long_features(tables["stats"]), f"{out}/player_form"),
        "team_rolling": refresh(
            team.team_aggregates(tables.get("plays"), tables["team_stats"], first_play_season),
            f"{out}/team_rolling",
        ),
    }


def dataset_stages(
    tables: dict[str, DataFrame],
    stages: dict[str, DataFrame],
    out: str,
    min_quality: float = config.MIN_QUALITY,
    matchup_alignment: str = "lagged",
) -> dict[str, DataFrame]:
    """Vectors, quality filter, targets, temporal split, validation log."""
    vectors = dataset.assemble(
        tables["stats"], tables["schedule"], stages["player_rolling"], stages["team_rolling"],
        stages["experience"], matchup_alignment,
    )
    vectors = refresh(vectors, f"{out}/vectors")
    good = quality.passing(quality.score_quality(vectors), min_quality)
    found = targets.targets(good, tables["stats"], tables["schedule"])
    split = refresh(temporal.temporal_split(targets.with_targets(good, found)), f"{out}/ml_features")
    log = temporal.leak_checks(split)
    write_aligned(log, f"{out}/validation_log", mode="append")
    return {"ml_features": split, "validation_log": log}


def build(
    tables: dict[str, DataFrame],
    out: str,
    first_play_season: int = config.PLAYS_FIRST_SEASON,
    matchup_alignment: str = "lagged",
    check: bool = True,
) -> dict[str, DataFrame]:
    """Run every stage in order; each writes its table and the next reads it.

    ``plays`` may be left out: team form then takes the defaults.
    """
    empty = quality.check_inputs(tables, REQUIRED)
    if "stats" in empty:
        raise ValueError("no player statistics to build from")
    stages = entity_stages(tables, out)
    stages |= feature_stages(tables, out, first_play_season)
    stages |= dataset_stages(tables, stages, out, matchup_alignment=matchup_alignment)
    if check:
        temporal.require_clean(stages["validation_log"])
    return stages


def build_from_feeds(
    spark: SparkSession, feeds_root: str, seasons, raw_root: str, out: str, fmt: str = "parquet", **options
) -> tuple[dict[str, DataFrame], DataFrame]:
    """From feed files to the dataset: load what is new, then build on the raw tables.

    Every feed that the seasons offer is appended to its raw table below
    ``raw_root``, once per key, and the run reads those tables. Returns the
    stage tables and one counters row per feed.
    """
    counted = []
    raw: dict[str, DataFrame] = {}
    for name, rows in load_feeds(spark, feeds_root, seasons, RAW_FEEDS, fmt).items():
        by = [c for c in ("season",) if c in rows.columns and c in key_columns(rows, name)]
        raw[name], counts = incremental_append(
            rows, f"{raw_root}/{name}", name, partition_by=by, keys_path=f"{raw_root}/_keys/{name}"
        )
        counted.append(counts)
    tables = {k: raw[t] for k, t in RAW_INPUTS.items() if t in raw}
    return build(tables, out, **options), reduce(DataFrame.unionByName, counted)


def export_json(df: DataFrame, path: str) -> None:
    """Write a stage table with its nested columns as JSON text."""
    write_aligned(_nested_as_text(df), path, mode="replace")
