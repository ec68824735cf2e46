"""Joins and row mutations: j01-j15, m01-m03."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold.operators import joins as jn
from weekfold.operators import mutations as mt
from weekfold.operators import lifecycle, views
from weekfold.queries.base_sql import add_table
from weekfold.queries.registry import query
from weekfold.session import scratch_path
from weekfold.sources import stand_ins as src


@query("j01_preferred_source", """
SELECT c_custkey, coalesce(a.first_season, b.first_season) AS first_season, coalesce(a.last_season, b.last_season) AS last_season
FROM customer
LEFT JOIN (SELECT o_custkey, min(season) AS first_season, max(season) AS last_season FROM order_periods
           WHERE o_orderstatus = 'O' GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, min(season) AS first_season, max(season) AS last_season FROM order_periods GROUP BY 1) b
  ON b.o_custkey = c_custkey""", ["order_periods"])
def j01(spark, root):
    o = src.order_periods(spark, root).withColumnRenamed("o_custkey", "c_custkey")
    return jn.prefer(
        src.table(spark, root, "customer").select("c_custkey"),
        lifecycle.span(o.filter(F.col("o_orderstatus") == "O"), "c_custkey"),
        lifecycle.span(o, "c_custkey"), ["c_custkey"], ["first_season", "last_season"],
    )


@query("j02_inner_join", """
SELECT g.player_id, g.season, g.week, p.college, p.draft_year FROM order_games g JOIN players p USING (player_id)
WHERE p.status = 'ACT'""", ["order_games", "players"])
def j02(spark, root):
    active = src.players(spark, root).filter(F.col("status") == "ACT").select("player_id", "college", "draft_year")
    return src.order_games(spark, root).select("player_id", "season", "week").join(active, "player_id")


@query("j03_left_join_unmatched", """
SELECT t.team, t.season, t.week, round(coalesce(avg(coalesce(g.fantasy_points, 0)), 0.0), 6) AS avg_allowed
FROM (SELECT DISTINCT team, season, week FROM order_games) t
LEFT JOIN order_games g ON g.opponent_team = t.team AND g.season = t.season AND g.week = t.week AND g.position = 'QB'
GROUP BY t.team, t.season, t.week""", ["order_games"])
def j03(spark, root):
    g = src.order_games(spark, root)
    faced = g.filter(F.col("position") == "QB").groupBy(F.col("opponent_team").alias("team"), "season", "week").agg(
        F.avg(F.coalesce("fantasy_points", F.lit(0.0))).alias("a")
    )
    return g.select("team", "season", "week").distinct().join(faced, ["team", "season", "week"], "left").select(
        "team", "season", "week", F.round(F.coalesce("a", F.lit(0.0)), 6).alias("avg_allowed")
    )


@query("j04_team_game_join", """
SELECT g.player_id, g.season, g.week, s.game_id, s.div_game FROM order_games g
LEFT JOIN schedule s ON s.season = g.season AND s.week = g.week AND (g.team = s.home_team OR g.team = s.away_team)""",
       ["order_games", "schedule"])
def j04(spark, root):
    games = src.order_games(spark, root).select("player_id", "season", "week", "team")
    return jn.attach_game(games, src.schedule(spark, root), ["game_id", "div_game"]).drop("team")


@query("j05_earlier_rows", """
SELECT a.player_id, a.season, a.week, count(b.player_id) AS games_before,
  round(coalesce(avg(b.fantasy_points), 0.0), 6) AS avg_before
FROM order_games a LEFT JOIN order_games b ON b.player_id = a.player_id
  AND (b.season < a.season OR (b.season = a.season AND b.week < a.week))
GROUP BY a.player_id, a.season, a.week""", ["order_games"])
def j05(spark, root):
    seen = jn.earlier_totals(src.order_games(spark, root), ["player_id"], {
        "games_before": F.count(F.lit(1)), "avg_before": F.avg("fantasy_points"),
    })
    return seen.select("player_id", "season", "week", "games_before",
                       F.round(F.coalesce("avg_before", F.lit(0.0)), 6).alias("avg_before"))


add_table("weekly_allowed", ("order_games",), """
SELECT opponent_team, position, season, week, count(*) AS n, sum(fantasy_points) AS points
FROM order_games GROUP BY opponent_team, position, season, week""")


@query("j06_since_last_season", """
SELECT a.opponent_team, a.position, a.season, a.week, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS games,
  round(coalesce(sum(b.points), 0.0), 6) AS points
FROM weekly_allowed a LEFT JOIN weekly_allowed b ON b.opponent_team = a.opponent_team AND b.position = a.position
  AND (b.season < a.season OR (b.season = a.season AND b.week < a.week)) AND b.season >= a.season - 1
GROUP BY a.opponent_team, a.position, a.season, a.week""", ["weekly_allowed"])
def j06(spark, root):
    weekly = src.order_games(spark, root).groupBy("opponent_team", "position", "season", "week").agg(
        F.count(F.lit(1)).alias("games"), F.sum("fantasy_points").alias("points")
    )
    out = jn.since_last_season(weekly, ["opponent_team", "position"], ["games", "points"])
    return out.withColumn("points", F.round("points", 6))


@query("j07_lag_join", """
SELECT a.player_id, a.season, a.week, b.orders AS last_orders FROM order_games a JOIN order_games b
  ON b.player_id = a.player_id AND b.season = a.season AND b.week + 1 = a.week AND b.week < 18""", ["order_games"])
def j07(spark, root):
    g = src.order_games(spark, root).select("player_id", "season", "week", "orders")
    lagged = jn.lag_period(g.withColumnRenamed("orders", "last_orders"))
    return g.drop("orders").join(lagged, ["player_id", "season", "week"])


@query("j08_role_played_join", """
SELECT g.player_id, g.season, g.week, o.games AS own_games, p.games AS opp_games
FROM order_games g
LEFT JOIN (SELECT team, season, week, count(*) AS games FROM order_games GROUP BY 1, 2, 3) o
  ON o.team = g.team AND o.season = g.season AND o.week = g.week
LEFT JOIN (SELECT team, season, week, count(*) AS games FROM order_games GROUP BY 1, 2, 3) p
  ON p.team = g.opponent_team AND p.season = g.season AND p.week = g.week""", ["order_games"])
def j08(spark, root):
    g = src.order_games(spark, root).select("player_id", "season", "week", "team", "opponent_team")
    per_team = g.groupBy("team", "season", "week").agg(F.count(F.lit(1)).alias("games"))
    own = jn.with_prefix(per_team, "own_", ["games"])
    opp = jn.with_prefix(per_team, "opp_", ["games"], {"team": "opponent_team"})
    return g.join(own, ["team", "season", "week"], "left").join(
        opp, ["opponent_team", "season", "week"], "left"
    ).select("player_id", "season", "week", "own_games", "opp_games")


@query("j09_one_row_join", """
SELECT player_id, season, week, (ms - season) * 18 + (mw - week) AS weeks_ago
FROM order_games, (SELECT max(season) AS ms, max(week) AS mw FROM order_games)""", ["order_games"])
def j09(spark, root):
    g = src.order_games(spark, root).select("player_id", "season", "week")
    newest = src.order_periods(spark, root).agg(F.max("season").alias("ms"), F.max("week").alias("mw"))
    return jn.with_one_row(g, newest).select(
        "player_id", "season", "week",
        ((F.col("ms") - F.col("season")) * 18 + (F.col("mw") - F.col("week"))).alias("weeks_ago"),
    )


@query("j10_roster_changes", """
SELECT team, season, week, gsis_id, true AS joined FROM rosters c WHERE NOT EXISTS (
  SELECT 1 FROM rosters p WHERE p.team = c.team AND p.season = c.season AND p.week = c.week - 1 AND p.gsis_id = c.gsis_id)
UNION ALL
SELECT team, season, week + 1, gsis_id, false FROM rosters p WHERE NOT EXISTS (
  SELECT 1 FROM rosters c WHERE c.team = p.team AND c.season = p.season AND c.week = p.week + 1 AND c.gsis_id = p.gsis_id)""",
       ["rosters"])
def j10(spark, root):
    return lifecycle.roster_changes(src.rosters(spark, root))


@query("j11_semi_join", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def j11(spark, root):
    machine = src.table(spark, root, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    o = src.table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return o.join(machine, o.o_custkey == machine.c_custkey, "left_semi")


@query("j12_scalar_subquery", """
SELECT player_id, season, week FROM order_games WHERE season = (SELECT max(season) FROM order_games)""", ["order_games"])
def j12(spark, root):
    return views.latest_season(src.order_games(spark, root)).select("player_id", "season", "week")


@query("j13_min_game_date", """
SELECT DISTINCT r.team, r.season, r.week, (SELECT CAST(min(gameday) AS TIMESTAMP) FROM schedule s WHERE s.season = r.season AND s.week = r.week
  AND (s.home_team = r.team OR s.away_team = r.team)) AS snapshot_date
FROM rosters r""", ["rosters", "schedule"])
def j13(spark, root):
    dates = jn.team_games(src.schedule(spark, root)).groupBy("team", "season", "week").agg(
        F.min("gameday").cast("timestamp").alias("snapshot_date")
    )
    return src.rosters(spark, root).select("team", "season", "week").distinct().join(
        dates, ["team", "season", "week"], "left"
    )


@query("j14_last_meetings", """
SELECT player_id, season, week, back, t FROM (
  SELECT a.player_id, a.season, a.week, b.season * 100 + b.week AS t,
    row_number() OVER (PARTITION BY a.player_id, a.season, a.week ORDER BY b.season DESC, b.week DESC) - 1 AS back
  FROM order_games a JOIN order_games b ON b.player_id = a.player_id AND b.opponent_team = a.opponent_team
    AND (b.season < a.season OR (b.season = a.season AND b.week < a.week))) WHERE back < 3""", ["order_games"])
def j14(spark, root):
    fields = {"t": F.col("season") * 100 + F.col("week")}
    met = jn.last_meetings(src.order_games(spark, root), ["player_id", "opponent_team"], fields)
    return met.select("player_id", "season", "week", F.posexplode("history").alias("back", "h")).select(
        "player_id", "season", "week", F.col("back").cast("bigint").alias("back"), F.col("h.t").alias("t")
    )


@query("j15_merge_on_key", """
SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spend, count(DISTINCT week) AS months
FROM order_periods GROUP BY o_custkey""", ["order_periods"])
def j15(spark, root):
    o = src.order_periods(spark, root)
    by = o.groupBy("o_custkey")
    months = o.select("o_custkey", "week").distinct().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("months"))
    return jn.merge_on_key([
        by.agg(F.count(F.lit(1)).alias("orders")),
        by.agg(F.round(F.sum("o_totalprice"), 2).alias("spend")),
        months,
    ], ["o_custkey"])


# --- row mutations -----------------------------------------------------------------
@query("m01_update_from", """
SELECT c_custkey, c_nationkey, coalesce(n.segment, c_mktsegment) AS c_mktsegment FROM customer
LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS segment FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) n
  ON n.o_custkey = c_custkey""")
def m01(spark, root):
    changes = src.table(spark, root, "orders").filter(F.col("o_orderstatus") == "O").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    base = src.table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return jn.update_from(base, changes, ["c_custkey"], ["c_mktsegment"])


@query("m02_delete_where", """
SELECT player_id, season, week, round(fg_pct, 6) AS fg_pct FROM player_games WHERE NOT coalesce(fg_pct < 0.5, false)""",
       ["player_games"])
def m02(spark, root):
    g = src.player_games(spark, root).select("player_id", "season", "week", "fg_pct")
    return jn.delete_where(g, F.col("fg_pct") < 0.5).withColumn("fg_pct", F.round("fg_pct", 6))


def _stored_games(spark, root, name):
    g = src.player_games(spark, root).select("player_id", "season", "week", "fg_pct", "fantasy_points")
    path = scratch_path(spark, name)
    g.write.partitionBy("season", "week").parquet(path)
    return g, path


@query("m01_update_stored", """
SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week,
  round(CASE WHEN season = 1997 AND player_id % 2 = 0 THEN fantasy_points * 2 ELSE fantasy_points END, 6) AS fantasy_points FROM player_games""",
       ["player_games"])
def m01_stored(spark, root):
    """One season of a stored table is corrected; its other partitions are not written."""
    games, path = _stored_games(spark, root, "update")
    changes = games.filter((F.col("season") == 1997) & (F.col("player_id") % 2 == 0)).select(
        "player_id", "season", "week", (F.col("fantasy_points") * 2).alias("fantasy_points")
    )
    mt.update_stored(
        spark, path, changes, ["player_id", "season", "week"], ["fantasy_points"], ["season", "week"], games.schema
    )
    return spark.read.schema(games.schema).parquet(path).select(
        "player_id", F.col("season").cast("bigint").alias("season"), F.col("week").cast("bigint").alias("week"),
        F.round("fantasy_points", 6).alias("fantasy_points"),
    )


@query("m02_delete_stored", """
SELECT player_id, CAST(season AS BIGINT) AS season, CAST(week AS BIGINT) AS week, round(fg_pct, 6) AS fg_pct FROM player_games
WHERE NOT coalesce(fg_pct < 0.5 AND season >= 1999 OR season = 1996, false)""", ["player_games"])
def m02_stored(spark, root):
    """A whole season goes with its files, and rows of later ones."""
    games, path = _stored_games(spark, root, "delete")
    condition = ((F.col("fg_pct") < 0.5) & (F.col("season") >= 1999)) | (F.col("season") == 1996)
    mt.delete_stored(spark, path, condition, ["season", "week"], games.schema)
    return spark.read.schema(games.schema).parquet(path).select(
        "player_id", F.col("season").cast("bigint").alias("season"), F.col("week").cast("bigint").alias("week"),
        F.round("fg_pct", 6).alias("fg_pct"),
    )


@query("m03_add_missing_column", """
SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS split FROM nation""")
def m03(spark, root):
    n = src.table(spark, root, "nation").select("n_nationkey", "n_name")
    return jn.add_missing(jn.add_missing(n, "split", "string"), "n_name", "string")
