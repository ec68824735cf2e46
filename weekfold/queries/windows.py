"""Window functions: w01-w11."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold.operators import windows as win
from weekfold.queries.features import rounded
from weekfold.queries.registry import query
from weekfold.sources import stand_ins as src

_FRAME = "OVER (PARTITION BY {e} ORDER BY {o} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def _events(spark, root, measures):
    """Rolling measures of every user's event value over 3, 5 and 10 prior events."""
    return win.rolling_events(
        src.table(spark, root, "events").select("event_id", "user_id", "ts", "value"),
        entity=["user_id"], order=["ts", "event_id"], stats=["value"],
        slice_by=F.date_trunc("minute", "ts"), measures=measures, keep=["event_id", "user_id"],
    )


def _events_sql(measures):
    exprs = {
        "avg": "avg(value) {f}",
        "stddev": "stddev_samp(value) {f}",
        "trend": "regr_slope(value, CAST(n AS DOUBLE)) {f}",
        "min": "min(value) {f}",
        "max": "max(value) {f}",
    }
    cols = []
    for w in (3, 5, 10):
        frame = _FRAME.format(e="user_id", o="ts, event_id", n=w)
        for m in measures:
            e = exprs[m].format(f=frame)
            cols.append(
                f"round(CASE WHEN isnan({e}) THEN NULL ELSE {e} END, 6) AS value_{m}_{w}"
            )
        cols.append(f"count(*) {frame} AS games_in_window_{w}")
    return f"""
SELECT event_id, user_id, n AS event_number, {', '.join(cols)}
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""


def _register(name, measures):
    @query(name, _events_sql(measures))
    def run(spark, root):
        return rounded(_events(spark, root, measures))


_register("w00_rolling_all", list(win.MEASURES))
for _name, _measures in {
    "w02_rolling_avg": ["avg"],
    "w03_rolling_stddev": ["stddev"],
    "w04_rolling_trend": ["trend"],
    "w05_rolling_min": ["min"],
    "w06_rolling_max": ["max"],
    "w07_games_in_window": [],
}.items():
    _register(_name, _measures)


@query("w01_sequence_number", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_number
FROM events""")
def w01(spark, root):
    e = src.table(spark, root, "events").select("event_id", "user_id", "ts")
    numbered = win.number_events(e, ["user_id"], ["ts", "event_id"], F.date_trunc("minute", "ts"))
    return numbered.select("event_id", "user_id", F.col("event_number").cast("bigint").alias("event_number"))


@query("w01_game_number", """
SELECT player_id, season, week, row_number() OVER (PARTITION BY player_id ORDER BY season, week) AS game_number
FROM order_games""", ["order_games"])
def w01_games(spark, root):
    games = win.game_number(src.order_games(spark, root).select("player_id", "season", "week"))
    return games.withColumn("game_number", F.col("game_number").cast("bigint"))


@query("w08_rank_in_period", """
SELECT season, week, team, round(points, 6) AS points,
  rank() OVER (PARTITION BY season, week ORDER BY round(points, 6)) AS rank
FROM (SELECT season, week, team, sum(fantasy_points) AS points FROM order_games GROUP BY ALL)""",
       ["order_games"])
def w08(spark, root):
    per_team = src.order_games(spark, root).groupBy("season", "week", "team").agg(
        F.round(F.sum("fantasy_points"), 6).alias("points")
    )
    ranked = win.rank_in_period(per_team, "points")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


@query("w09_period_rank", """
SELECT g.player_id, g.season, g.week, p.time_rank, p.total_periods
FROM order_games g JOIN (
  SELECT season, week, row_number() OVER (ORDER BY season, week) AS time_rank,
         count(*) OVER () AS total_periods
  FROM (SELECT DISTINCT season, week FROM order_games)) p USING (season, week)""", ["order_games"])
def w09(spark, root):
    games = src.order_games(spark, root).select("player_id", "season", "week")
    ranks = win.period_rank(src.order_periods(spark, root))
    return games.join(ranks, ["season", "week"]).select(
        "player_id", "season", "week",
        F.col("time_rank").cast("bigint").alias("time_rank"), "total_periods",
    )


@query("w10_calendar_window", """
SELECT t.team, t.season, t.target_week AS target_week, count(*) AS plays,
  count(DISTINCT p.game_id || ':' || p.drive) AS drives, round(avg(p.epa), 6) AS mean_epa
FROM (SELECT DISTINCT posteam AS team, season, w.k + week AS target_week
      FROM plays, (SELECT unnest([1, 2, 3]) AS k) w) t
JOIN plays p ON p.posteam = t.team AND p.season = t.season
  AND p.week BETWEEN t.target_week - 3 AND t.target_week - 1
GROUP BY t.team, t.season, t.target_week""", ["plays"])
def w10(spark, root):
    plays = src.plays(spark, root)
    # drives first: the fan-out then runs over weekly totals, never over plays
    drives = plays.groupBy("posteam", "season", "week", "game_id", "drive").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("epa").alias("epa")
    )
    weekly = drives.groupBy("posteam", "season", "week").agg(
        F.sum("plays").alias("plays"), F.count(F.lit(1)).alias("drives"), F.sum("epa").alias("epa")
    )
    return (
        win.spread_forward(weekly)
        .groupBy(F.col("posteam").alias("team"), "season", "target_week")
        .agg(
            F.sum("plays").alias("plays"), F.sum("drives").alias("drives"),
            F.round(F.sum("epa") / F.sum("plays"), 6).alias("mean_epa"),
        )
    )


@query("w11_last_n_lookback", """
SELECT a.player_id, a.season, a.week, round(coalesce(avg(f.fantasy_points), 0.0), 6) AS avg_fantasy_points,
  count(f.player_id) AS games_in_window
FROM (SELECT player_id, max(season * 100 + week) // 100 AS season,
             max(season * 100 + week) % 100 AS week FROM order_games GROUP BY player_id) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY season DESC, week DESC) AS back
           FROM order_games) f
  ON f.player_id = a.player_id AND f.back BETWEEN 2 AND 4
GROUP BY a.player_id, a.season, a.week""", ["order_games"])
def w11(spark, root):
    games = src.order_games(spark, root)
    latest = games.groupBy("player_id").agg(F.max(F.col("season") * 100 + F.col("week")).alias("t"))
    at = latest.select(
        "player_id", F.floor(F.col("t") / 100).alias("season"), (F.col("t") % 100).alias("week")
    )
    out = win.lookback(games, at, ["fantasy_points"], 3)
    return out.select(
        "player_id", "season", "week",
        F.round("avg_fantasy_points", 6).alias("avg_fantasy_points"),
        F.col("games_in_window").cast("bigint").alias("games_in_window"),
    )
