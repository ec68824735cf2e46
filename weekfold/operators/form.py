"""Rolling player form: every statistic, window and measure in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.scalars import existing
from weekfold.operators.windows import MEASURES, column_name, rolling, rolling_long

IDENTITY = ("player_id", "player_name", "position", "season", "week", "team")


def trend_stats() -> list[str]:
    """Statistics whose slope enters a composite trend."""
    names = []
    for spec in config.TREND_WEIGHTS.values():
        names += [s for s, _, _ in spec["terms"] or []]
        names += [spec["fallback"], *spec["usage"], spec["share"]]
    return list(dict.fromkeys(n for n in names if n))


def relevant_positions(stat: str) -> list[str]:
    return [p for p in config.POSITION_STATS if stat in config.position_stats(p)]


def masked_stats(df: DataFrame, stats, shared=("fantasy_points",)) -> DataFrame:
    """Blank out statistics that do not belong to a row's position.

    Position then needs no loop: one window pass serves every position, and
    what does not apply stays null.
    """
    def text(c: str) -> str:
        if c not in stats or c in shared:
            return f"`{c}`"
        inside = ", ".join(f"'{p}'" for p in relevant_positions(c))
        return f"CASE WHEN position IN ({inside}) THEN `{c}` END AS `{c}`"

    return df.selectExpr(*[text(c) for c in df.columns])


def rolling_features(
    stats: DataFrame,
    columns=None,
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    shared=("fantasy_points",),
    season_type: str | None = "REG",
    drop_first_before: bool = False,
    trends_only: bool = False,
    keep=(),
) -> DataFrame:
    """Rolling measures of all configured statistics the table has.

    With ``trends_only`` slopes are computed just where the composite trends
    read them, on top of ``measures``. ``keep`` names further columns to carry.

    Regular season only. Each (player, season, week) is unique, so partitions
    are bounded by the calendar and (season, week) is a complete order.
    """
    wanted = existing(stats, columns or [*config.all_stats(), *shared])
    games = stats.dropna(subset=["player_id"])
    if season_type is not None:
        games = games.filter(F.col("season_type") == season_type)
    keep = existing(games, dict.fromkeys([*IDENTITY, *keep]))
    games = masked_stats(games.select(*dict.fromkeys([*keep, *wanted])), wanted, shared)
    extra = [(s, "trend", config.TREND_WINDOW) for s in wanted if s in trend_stats()]
    return rolling(
        games, stats=wanted, windows=windows, measures=measures, keep=keep,
        drop_first_before=drop_first_before, extra=extra if trends_only else (),
    )


def rolling_long_features(
    stats: DataFrame,
    columns=None,
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    shared=("fantasy_points",),
    season_type: str | None = "REG",
    drop_first_before: bool = False,
    keep=(),
    places: int | None = None,
) -> DataFrame:
    """``rolling_features`` with a row for each statistic: the layout for all configured ones.

    A player has the statistics of the positions he ever had and the ``shared``
    ones; the values are those of the wide layout, rounded to ``places``.
    """
    wanted = existing(stats, columns or [*config.all_stats(), *shared])
    games = stats.dropna(subset=["player_id"])
    if season_type is not None:
        games = games.filter(F.col("season_type") == season_type)
    keep = existing(games, dict.fromkeys([*IDENTITY, *keep]))
    games = masked_stats(games.select(*dict.fromkeys([*keep, *wanted])), wanted, shared)
    groups = {p: [s for s in config.position_stats(p) if s not in shared] for p in config.POSITION_STATS}
    return rolling_long(
        games, stats=wanted, windows=windows, measures=measures, keep=keep,
        drop_first_before=drop_first_before, groups=groups, places=places,
    )


def long_documents(long: DataFrame, windows=config.ROLLING_WINDOWS, measures=MEASURES) -> DataFrame:
    """``documents`` from the long layout: one sparse JSON document for each window.

    The statistics of a player and week are gathered before a shuffle, as they come together.
    """
    docs = []
    for n in windows:
        entries = F.array(*[
            F.struct(F.concat("stat", F.lit(f"_{m}")).alias("key"), F.col(f"{m}_{n}").alias("value")) for m in measures
        ])
        found = F.flatten(F.collect_list(F.filter(entries, lambda e: e["value"].isNotNull())))
        head = F.array(
            F.struct(F.lit("window_size").alias("key"), F.lit(float(n)).alias("value")),
            F.struct(F.lit("games_in_window").alias("key"), F.first(f"games_in_window_{n}").cast("double").alias("value")),
        )
        name = "stats_season_avg" if n == max(windows) else f"stats_last{n}_games"
        docs.append(F.to_json(F.map_from_entries(F.concat(head, found))).alias(name))
    return long.groupBy("player_id", "season", "week", "position").agg(*docs)


def _slope(df: DataFrame, stat: str | None) -> Column | None:
    name = column_name(stat, "trend", config.TREND_WINDOW) if stat else None
    return F.col(name) if name in df.columns else None


def _performance(df: DataFrame, spec) -> Column:
    terms = [(_slope(df, s), w, k) for s, w, k in spec["terms"] or []]
    if terms and all(c is not None for c, _, _ in terms):
        total = F.lit(0.0)
        for slope, weight, scale in terms:
            total = total + F.lit(float(weight)) * F.coalesce(slope, F.lit(0.0)) * F.lit(float(scale))
        return total
    alone = _slope(df, spec["fallback"])
    return alone if alone is not None else F.lit(None).cast("double")


def _usage(df: DataFrame, spec) -> Column:
    first, *more = [_slope(df, s) for s in spec["usage"]]
    if first is None:
        return F.lit(None).cast("double")
    if more and more[0] is not None:
        return F.coalesce(first, F.lit(0.0)) + F.coalesce(more[0], F.lit(0.0))
    return first


def _share(df: DataFrame, spec) -> Column:
    slope = _slope(df, spec["share"])
    return slope if slope is not None else F.lit(None).cast("double")


def composite_trends(df: DataFrame) -> DataFrame:
    """performance, usage and target-share trends from the five-game slopes.

    Rounded to nine places: the slope of a flat series is 0, not the 1e-17 that
    accumulates in floating point and would count as a present value later.
    """
    out = {}
    for name, build in (
        ("performance_trend", _performance), ("usage_trend", _usage), ("target_share_trend", _share)
    ):
        chosen = F
        for position, spec in config.TREND_WEIGHTS.items():
            chosen = chosen.when(F.col("position") == position, build(df, spec))
        out[name] = F.round(chosen.otherwise(F.lit(None).cast("double")), 9)
    return df.withColumns(out)


def documents(df: DataFrame, windows=config.ROLLING_WINDOWS, measures=MEASURES) -> DataFrame:
    """The rolling measures of each window as one sparse JSON document.

    The longest window is stored under the name of the season average.
    """
    stats = [
        s for s in [*config.all_stats(), "fantasy_points"]
        if column_name(s, measures[0], windows[0]) in df.columns
    ]
    docs = []
    for n in windows:
        fields = [f"{n}D AS window_size", f"cast(games_in_window_{n} AS double) AS games_in_window"]
        fields += [f"`{column_name(s, m, n)}` AS `{s}_{m}`" for s in stats for m in measures]
        name = "stats_season_avg" if n == max(windows) else f"stats_last{n}_games"
        # to_json leaves null fields out, which makes the document sparse
        docs.append(f"to_json(struct({', '.join(fields)})) AS {name}")
    keep = ["player_id", "season", "week", "position"]
    trends = existing(df, ["performance_trend", "usage_trend", "target_share_trend"])
    return df.selectExpr(*keep, *docs, *trends)
