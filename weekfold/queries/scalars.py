"""Projections, predicates, scalar functions, arrays and JSON: p01-p19, x01-x11."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions import nested as nx
from weekfold.functions import scalars as fx
from weekfold.operators import views
from weekfold.operators.joins import with_one_row
from weekfold.queries.registry import query
from weekfold.sources import stand_ins as src


def _big(df, *names):
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


@query("p01_not_null_filter", """
SELECT player_id, season, week, round(fg_pct, 6) AS fg_pct, round(target_share, 6) AS target_share
FROM player_games WHERE fg_pct IS NOT NULL AND target_share IS NOT NULL AND team IS NOT NULL""",
       ["player_games"])
def p01(spark, root):
    g = src.player_games(spark, root).dropna(subset=["fg_pct", "target_share", "team"])
    return g.select("player_id", "season", "week", F.round("fg_pct", 6).alias("fg_pct"),
                    F.round("target_share", 6).alias("target_share"))


@query("p02_membership_range", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag IN ('A', 'N') AND l_linenumber IN (1, 2) AND l_quantity BETWEEN 10 AND 20
  AND l_discount > 0.02""")
def p02(spark, root):
    li = src.table(spark, root, "lineitem")
    return li.filter(
        F.col("l_returnflag").isin("A", "N") & F.col("l_linenumber").isin(1, 2)
        & F.col("l_quantity").between(10, 20) & (F.col("l_discount") > 0.02)
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("p03_before_period", """
SELECT player_id, season, week, orders FROM order_games
WHERE season < 1998 OR (season = 1998 AND week < 7)""", ["order_games"])
def p03(spark, root):
    return src.order_games(spark, root).filter(fx.before(1998, 7)).select(
        "player_id", "season", "week", "orders"
    )


@query("p04_pattern_filter", """
SELECT page_id, url FROM pages WHERE url LIKE '%win%' OR url LIKE '%loss%' OR url LIKE '%final%'
  OR url LIKE '%result%' OR url LIKE '%outcome%'""")
def p04(spark, root):
    return src.table(spark, root, "pages").filter(fx.leaks_outcome("url")).select("page_id", "url")


@query("p05_optional_filters", """
SELECT player_id, season, week, team, round(fantasy_points, 6) AS fantasy_points
FROM order_games WHERE team = 7 AND season = 1999""", ["order_games"])
def p05(spark, root):
    found = views.lookup(src.order_games(spark, root), team=7, season=1999, week=None)
    return found.select("player_id", "season", "week", "team",
                        F.round("fantasy_points", 6).alias("fantasy_points"))


_PLAYED = "(season - first_season + 1)"
_BAND_SQL = f"CASE WHEN {_PLAYED} <= 1 THEN 'rookie' WHEN {_PLAYED} IN (2, 3) THEN 'developing' ELSE 'veteran' END"


@query("p06_experience_band", f"""
SELECT o_custkey AS player_id, season, CAST({_PLAYED} AS BIGINT) AS seasons_played, {_BAND_SQL} AS category,
  CASE WHEN {_PLAYED} <= 1 THEN 'high_variance_model' WHEN {_PLAYED} <= 3 THEN 'mixed_model'
       ELSE 'historical_trend_model' END AS strategy,
  CAST(CASE WHEN {_PLAYED} <= 1 THEN 0.6 WHEN {_PLAYED} <= 3 THEN 0.8 ELSE 1.0 END AS DOUBLE) AS confidence
FROM (SELECT o_custkey, season, min(season) OVER (PARTITION BY o_custkey) AS first_season
      FROM (SELECT DISTINCT o_custkey, season FROM order_periods))""", ["order_periods"])
def p06(spark, root):
    seasons = src.order_periods(spark, root).select("o_custkey", "season").distinct()
    first = seasons.groupBy("o_custkey").agg(F.min("season").alias("first_season"))
    played = fx.seasons_played()
    return seasons.join(first, "o_custkey").select(
        F.col("o_custkey").alias("player_id"), "season",
        played.cast("bigint").alias("seasons_played"),
        fx.experience_band(played).alias("category"),
        fx.experience_strategy(played).alias("strategy"),
        fx.experience_confidence(played).alias("confidence"),
    )


@query("p07_seasons_played", """
SELECT o_orderkey, CAST(season - 1995 + 1 AS BIGINT) AS seasons_played FROM order_periods""", ["order_periods"])
def p07(spark, root):
    return src.order_periods(spark, root).select(
        "o_orderkey", fx.seasons_played("season", F.lit(1995)).cast("bigint").alias("seasons_played")
    )


@query("p08_safe_division", """
SELECT player_id, season, week,
  round(coalesce(completions / nullif(CAST(attempts AS DOUBLE), 0), 0.0), 6) AS completion_pct,
  round(rushing_yards / nullif(CAST(carries AS DOUBLE), 0), 6) AS yards_per_carry
FROM player_games""", ["player_games"])
def p08(spark, root):
    return src.player_games(spark, root).select(
        "player_id", "season", "week",
        F.round(fx.safe_divide("completions", "attempts", 0.0), 6).alias("completion_pct"),
        F.round(fx.safe_divide("rushing_yards", "carries"), 6).alias("yards_per_carry"),
    )


@query("p09_null_safe_sum", """
SELECT player_id, season, week,
  round(coalesce(fg_pct, 0) + coalesce(target_share, 0) + coalesce(air_yards_share, 0), 6) AS total
FROM player_games""", ["player_games"])
def p09(spark, root):
    return src.player_games(spark, root).select(
        "player_id", "season", "week",
        F.round(fx.null_safe_sum("fg_pct", "target_share", "air_yards_share"), 6).alias("total"),
    )


@query("p11_key_construction", """
SELECT team || '_' || season || '_W' || week AS snapshot_id,
  concat(player_id, '_', season, '_', week) AS feature_id FROM order_games""", ["order_games"])
def p11(spark, root):
    return src.order_games(spark, root).select(
        fx.snapshot_key().alias("snapshot_id"), fx.feature_key().alias("feature_id")
    )


@query("p12_clock_minutes", """
SELECT game_id, drive, down, yards_gained, drive_time_of_possession,
  round(CAST(split_part(drive_time_of_possession, ':', 1) AS INTEGER)
        + CAST(split_part(drive_time_of_possession, ':', 2) AS INTEGER) / 60.0, 6) AS minutes
FROM plays""", ["plays"])
def p12(spark, root):
    return src.plays(spark, root).select(
        "game_id", "drive", "down", "yards_gained", "drive_time_of_possession",
        F.round(fx.clock_minutes("drive_time_of_possession"), 6).alias("minutes"),
    )


@query("p13_period_from_timestamp", """
SELECT o_orderkey, dt,
  CAST(CASE WHEN o_orderkey % 10 = 0 OR month(o_orderdate) <= 8 THEN 1
       ELSE trunc((dayofyear(o_orderdate) - 244) / 7.0 + 1) END AS BIGINT) AS week
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS dt FROM orders)""")
def p13(spark, root):
    o = src.table(spark, root, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    parsed = fx.parse_period(o.select("o_orderkey", text.alias("dt")))
    return _big(parsed.select("o_orderkey", "dt", "week"), "week")


@query("p14_categorical_encoding", f"""
SELECT player_id, season, week, position AS position_value,
  CAST(CASE position WHEN 'QB' THEN 1 WHEN 'RB' THEN 2 WHEN 'WR' THEN 3 WHEN 'TE' THEN 4 WHEN 'K' THEN 5 ELSE 0 END AS BIGINT) AS position_code,
  CASE WHEN team < opponent_team THEN 'home' WHEN team > opponent_team THEN 'away' ELSE 'neutral' END AS role_value,
  CAST(CASE WHEN team < opponent_team THEN 1 WHEN team > opponent_team THEN 0 ELSE -1 END AS BIGINT) AS role_code,
  orders > 1 AS flag_value, CAST(orders > 1 AS BIGINT) AS flag_code,
  CASE WHEN season = 1995 THEN 'unknown' WHEN season = 1996 THEN 'rookie' WHEN season <= 1998 THEN 'developing' ELSE 'veteran' END AS experience_value,
  CAST(CASE WHEN season = 1995 THEN 0 WHEN season = 1996 THEN 1 WHEN season <= 1998 THEN 2 ELSE 3 END AS BIGINT) AS experience_code
FROM order_games""", ["order_games"])
def p14(spark, root):
    home = F.least("team", "opponent_team")
    away = F.greatest("team", "opponent_team")
    role = F.when(F.col("team") == F.col("opponent_team"), F.lit("neutral")).otherwise(
        fx.game_role("team", home, away)
    )
    played = F.col("season") - 1995
    band = F.when(played > 0, fx.experience_band(played))
    g = src.order_games(spark, root).select(
        "player_id", "season", "week",
        fx.encode_position().alias("position"), fx.encode_role(role).alias("role"),
        fx.encode_flag(F.col("orders") > 1).alias("flag"), fx.encode_experience(band).alias("experience"),
    )
    return g.select(
        "player_id", "season", "week",
        *[c for n in ("position", "role", "flag", "experience") for c in (
            F.col(f"{n}.value").alias(f"{n}_value"),
            F.col(f"{n}.encoded").cast("bigint").alias(f"{n}_code"))],
    )


@query("p15_home_away_role", """
SELECT game_id, team, game_role AS role FROM team_games""", ["team_games"])
def p15(spark, root):
    games = src.schedule(spark, root)
    teams = games.select("*", F.explode(F.array("home_team", "away_team")).alias("team"))
    return teams.select("game_id", "team", fx.game_role("team", "home_team", "away_team").alias("role"))


@query("p16_game_outcome", """
SELECT game_id, CAST(CASE WHEN home_score > away_score THEN 1.0 WHEN home_score < away_score THEN 0.0 ELSE 0.5 END AS DOUBLE) AS home_win,
  CAST(CASE WHEN home_score > away_score THEN 0.0 WHEN home_score < away_score THEN 1.0 ELSE 0.5 END AS DOUBLE) AS away_win,
  home_score + away_score AS total_points, home_score - away_score AS score_diff
FROM schedule""", ["schedule"])
def p16(spark, root):
    win = fx.win_share("home_score", "away_score")
    return src.schedule(spark, root).select(
        "game_id", win.alias("home_win"), (F.lit(1.0) - win).alias("away_win"),
        (F.col("home_score") + F.col("away_score")).alias("total_points"),
        (F.col("home_score") - F.col("away_score")).alias("score_diff"),
    )


@query("p17_position_groups", """
SELECT p_partkey, code, code IN ('QB','RB','FB','WR','TE','C','G','T') AS offensive,
  code IN ('DE','DT','NT','LB','ILB','OLB','CB','S','FS','SS') AS defensive,
  CASE WHEN code = 'QB' THEN 'QB' WHEN code IN ('RB','FB') THEN 'RB' WHEN code = 'WR' THEN 'WR'
       WHEN code = 'TE' THEN 'TE' WHEN code IN ('C','G','T') THEN 'OL' WHEN code IN ('DE','DT','NT') THEN 'DL'
       WHEN code IN ('LB','ILB','OLB') THEN 'LB' WHEN code IN ('CB','S','FS','SS') THEN 'DB'
       WHEN code IN ('K','P','LS') THEN 'ST' END AS grp
FROM (SELECT p_partkey, ['QB','RB','FB','WR','TE','C','G','T','DE','DT','NT','LB','ILB','OLB','CB','S','FS','SS','K','P','LS','X'][CAST(p_partkey % 22 AS INTEGER) + 1] AS code FROM part)""")
def p17(spark, root):
    codes = [*config.OFFENSIVE_POSITIONS, *config.DEFENSIVE_POSITIONS, "K", "P", "LS", "X"]
    code = F.element_at(nx.text_array(codes), (F.col("p_partkey") % len(codes) + 1).cast("int"))
    return src.table(spark, root, "part").select("p_partkey", code.alias("code")).select(
        "p_partkey", "code", fx.is_offensive("code").alias("offensive"),
        fx.is_defensive("code").alias("defensive"), fx.position_group("code").alias("grp"),
    )


@query("p18_z_score", """
SELECT o_orderkey, round(abs((o_totalprice - m) / s), 6) AS z_score
FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)""")
def p18(spark, root):
    o = src.table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    stats = o.agg(F.avg("o_totalprice").alias("mean"), F.stddev_samp("o_totalprice").alias("std"))
    return with_one_row(o, stats).select(
        "o_orderkey", F.round(fx.z_score("o_totalprice", "mean", "std"), 6).alias("z_score")
    )


@query("p19_column_pruning", """
SELECT player_id, season, week, CAST(attempts AS BIGINT) AS attempts, completions, round(passing_yards, 6) AS passing_yards, passing_tds,
  passing_interceptions, round(passing_epa, 6) AS passing_epa, sacks_suffered, carries, round(rushing_yards, 6) AS rushing_yards,
  rushing_tds, round(rushing_epa, 6) AS rushing_epa
FROM player_games WHERE position = 'QB'""", ["player_games"])
def p19(spark, root):
    g = src.player_games(spark, root).filter(F.col("position") == "QB")
    stats = fx.existing(g, config.position_stats("QB"))
    types = dict(g.dtypes)
    return g.select("player_id", "season", "week", *[
        F.round(s, 6).alias(s) if types[s] == "double" else F.col(s) for s in stats
    ])


# --- arrays and JSON ------------------------------------------------------------
@query("x01_json_object", """
SELECT o_orderkey, o_orderstatus AS status, round(o_totalprice, 2) AS price,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority, 3 AS fields
FROM orders""")
def x01(spark, root):
    o = src.table(spark, root, "orders")
    doc = nx.json_object(
        status=F.col("o_orderstatus"), price=F.col("o_totalprice"),
        priority=F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")),
    )
    return o.select("o_orderkey", doc.alias("doc")).select(
        "o_orderkey", nx.json_text("doc", "$.status").alias("status"),
        F.round(nx.json_number("doc", "$.price"), 2).alias("price"),
        nx.json_text("doc", "$.priority").alias("priority"),
        F.size(F.json_object_keys("doc")).cast("int").alias("fields"),
    )


@query("x02_json_array", """
SELECT player_id, count(*) AS entries, min(season * 100 + week) AS first_period, max(season * 100 + week) AS last_period
FROM order_games GROUP BY player_id""", ["order_games"])
def x02(spark, root):
    games = src.order_games(spark, root)
    # one row per period: an array per player is bounded by the calendar
    packed = games.groupBy("player_id").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct((F.col("season") * 100 + F.col("week")).alias("t"), "orders")))).alias("doc")
    )
    n = F.json_array_length("doc").cast("bigint")
    return packed.select(
        "player_id", n.alias("entries"),
        F.get_json_object("doc", "$[0].t").cast("bigint").alias("first_period"),
        F.element_at(F.from_json("doc", "array<struct<t:bigint>>"), -1).t.alias("last_period"),
    )


@query("x03_json_extract", """
SELECT event_id, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS DOUBLE) AS k,
  coalesce(TRY_CAST(json_extract_string(props, '$.missing') AS DOUBLE), -1.0) AS missing
FROM events""")
def x03(spark, root):
    return src.table(spark, root, "events").select(
        "event_id", nx.json_number("props", "$.k", 0.0).alias("k"),
        nx.json_number("props", "$.missing", -1.0).alias("missing"),
    )


@query("x05_filter_and_count", """
SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS positive,
  CAST(len(list_filter(embedding, lambda x: abs(x) > 0.2)) AS BIGINT) AS large
FROM embeddings""")
def x05(spark, root):
    return src.table(spark, root, "embeddings").select(
        "vec_id", nx.count_matching("embedding", lambda x: x > 0).cast("bigint").alias("positive"),
        nx.count_matching("embedding", lambda x: F.abs(x) > F.lit(0.2).cast("float")).cast("bigint").alias("large"),
    )


@query("x06_compact_nulls", """
SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'overdrawn' END,
  CASE WHEN c_nationkey = 3 THEN 'home_nation' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'machinery' END],
  lambda x: x IS NOT NULL), ',') AS flags FROM customer""")
def x06(spark, root):
    flags = nx.set_flags({
        "overdrawn": F.col("c_acctbal") < 0, "home_nation": F.col("c_nationkey") == 3,
        "machinery": F.col("c_mktsegment") == "MACHINERY",
    })
    return src.table(spark, root, "customer").select("c_custkey", F.array_join(flags, ",").alias("flags"))


@query("x07_conditional_append", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN array_to_string(list_append([c_mktsegment], 'no_target_data'), ',')
  ELSE c_mktsegment END AS flags FROM customer""")
def x07(spark, root):
    flags = nx.append_flag(F.array("c_mktsegment"), "no_target_data", F.col("c_acctbal") < 0)
    return src.table(spark, root, "customer").select("c_custkey", F.array_join(flags, ",").alias("flags"))


@query("x08_unnest", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS slot, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def x08(spark, root):
    e = src.table(spark, root, "embeddings").select("vec_id", F.posexplode("embedding").alias("slot", "value"))
    return e.select("vec_id", F.col("slot").cast("bigint").alias("slot"), F.col("value").cast("double").alias("value"))


@query("x09_decode_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def x09(spark, root):
    doc = F.from_json("props", "k bigint")
    return src.table(spark, root, "events").select("event_id", doc.k.alias("k"))


@query("x10_sparse_json", """
SELECT player_id, season, week,
  CAST((fg_pct IS NOT NULL)::INTEGER + (target_share IS NOT NULL)::INTEGER + 1 AS BIGINT) AS fields,
  round(fg_pct, 6) AS fg_pct, round(target_share, 6) AS target_share, CAST(carries AS DOUBLE) AS carries
FROM player_games""", ["player_games"])
def x10(spark, root):
    doc = nx.sparse_json({"fg_pct": F.col("fg_pct"), "target_share": F.col("target_share"), "carries": F.col("carries")})
    g = src.player_games(spark, root).select("player_id", "season", "week", doc.alias("doc"))
    return g.select(
        "player_id", "season", "week", F.size(F.json_object_keys("doc")).cast("bigint").alias("fields"),
        F.round(nx.json_number("doc", "$.fg_pct"), 6).alias("fg_pct"),
        F.round(nx.json_number("doc", "$.target_share"), 6).alias("target_share"),
        nx.json_number("doc", "$.carries").alias("carries"),
    )


@query("x11_widen_metrics", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS absent FROM events""")
def x11(spark, root):
    e = src.table(spark, root, "events").select("event_id", "props")
    return nx.widen_metrics(e, "props", ["k", "absent"]).drop("props")
