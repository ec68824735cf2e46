"""Aggregations, sorts, top-k, set operations and views: a01-a14, t01-t05, u01-u03, s09-s12."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold.functions import nested as nx
from weekfold.operators import lifecycle, quality, setops, views
from weekfold.queries.registry import query
from weekfold.sources import stand_ins as src


@query("a01_span", """
SELECT o_custkey AS player_id, min(season) AS first_season, max(season) AS last_season
FROM order_periods GROUP BY o_custkey""", ["order_periods"])
def a01(spark, root):
    return lifecycle.span(src.order_periods(spark, root), "o_custkey").select(
        F.col("o_custkey").alias("player_id"), "first_season", "last_season"
    )


@query("a02_ordered_distinct_list", """
SELECT o_custkey, array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority), ',') AS priorities
FROM orders GROUP BY o_custkey""")
def a02(spark, root):
    o = src.table(spark, root, "orders")
    return o.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities")
    )


@query("a03_list_of_structs", """
SELECT player_id, season, count(*) AS games, string_agg(week || ':' || orders, ',' ORDER BY week) AS log
FROM order_games GROUP BY player_id, season""", ["order_games"])
def a03(spark, root):
    # a player's season has at most as many entries as it has weeks
    packed = lifecycle.pack(src.order_games(spark, root), ["player_id", "season"], ["week", "orders"], "log")
    text = F.transform("log", lambda m: F.concat_ws(":", m.week.cast("string"), m.orders.cast("string")))
    return packed.select(
        "player_id", "season", F.size("log").cast("bigint").alias("games"),
        F.array_join(text, ",").alias("log"),
    )


@query("a04_filtered_count", """
SELECT season, count(*) FILTER (o_orderstatus = 'O') AS open_orders,
  CAST(sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS BIGINT) AS large_orders
FROM order_periods GROUP BY season""", ["order_periods"])
def a04(spark, root):
    return src.order_periods(spark, root).groupBy("season").agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        F.count_if(F.col("o_totalprice") > 100000).alias("large_orders"),
    )


@query("a05_distinct_count", """
SELECT season, count(DISTINCT o_custkey) AS players, count(DISTINCT week) AS weeks
FROM order_periods GROUP BY season""", ["order_periods"])
def a05(spark, root):
    return quality.distinct_per_group(src.order_periods(spark, root), ["season"], "o_custkey", "week").select(
        "season", F.col("o_custkey").alias("players"), F.col("week").alias("weeks")
    )


@query("a05_distinct_estimate", """
SELECT season, count(DISTINCT week) AS weeks, true AS players_close FROM order_periods GROUP BY season""", ["order_periods"])
def a05_estimate(spark, root):
    """Estimates are within 5 % of the exact counts; small ones are exact."""
    rows = src.order_periods(spark, root)
    exact = quality.distinct_per_group(rows, ["season"], "o_custkey").withColumnRenamed("o_custkey", "exact")
    found = quality.distinct_per_group(rows, ["season"], "o_custkey", "week", within=0.01).join(exact, "season")
    return found.select(
        "season", F.col("week").alias("weeks"),
        (F.abs(F.col("o_custkey") - F.col("exact")) <= 0.05 * F.col("exact")).alias("players_close"),
    )


@query("a06_grouped_mean", """
SELECT position, count(*) AS games, round(avg(fantasy_points), 6) AS avg_fantasy_points
FROM order_games GROUP BY position ORDER BY position""", ["order_games"])
def a06(spark, root):
    return src.order_games(spark, root).groupBy("position").agg(
        F.count(F.lit(1)).alias("games"), F.round(F.avg("fantasy_points"), 6).alias("avg_fantasy_points")
    ).orderBy("position")


@query("a07_ratio_of_sums", """
SELECT l_suppkey, round(count(*) FILTER (l_returnflag = 'R') / CAST(count(*) AS DOUBLE), 6) AS return_rate,
  round(sum(CASE WHEN l_linenumber = 3 AND l_linestatus = 'O' THEN 1 ELSE 0 END)
    / nullif(CAST(sum(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS DOUBLE), 0), 6) AS third_rate
FROM lineitem GROUP BY l_suppkey""")
def a07(spark, root):
    third = F.col("l_linenumber") == 3
    return src.table(spark, root, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1)), 6).alias("return_rate"),
        F.round(
            F.count_if(third & (F.col("l_linestatus") == "O")) / F.nullif(F.count_if(third), F.lit(0)), 6
        ).alias("third_rate"),
    )


@query("a08_global_stats", """
SELECT count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd FROM lineitem""")
def a08(spark, root):
    v = "l_extendedprice"
    return src.table(spark, root, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_samp(v), 4).alias("sd"),
    )


@query("a09_distinct_periods", """
SELECT DISTINCT o_custkey, season, week FROM order_periods""", ["order_periods"])
def a09(spark, root):
    return src.order_periods(spark, root).select("o_custkey", "season", "week").distinct()


@query("a10_two_level", """
SELECT posteam, season, count(*) AS drives, round(avg(scored), 6) AS scoring_rate
FROM (SELECT posteam, season, game_id, drive, max(touchdown) AS scored FROM plays GROUP BY ALL)
GROUP BY posteam, season""", ["plays"])
def a10(spark, root):
    drives = src.plays(spark, root).groupBy("posteam", "season", "game_id", "drive").agg(
        F.max("touchdown").alias("scored")
    )
    return drives.groupBy("posteam", "season").agg(
        F.count(F.lit(1)).alias("drives"), F.round(F.avg("scored"), 6).alias("scoring_rate")
    )


@query("a11_null_audit", """
SELECT season, count(*) AS total, count(*) - count(fg_pct) AS missing,
  round(100.0 * count(fg_pct) / count(*), 6) AS pct FROM player_games GROUP BY season""", ["player_games"])
def a11(spark, root):
    return quality.null_audit(src.player_games(spark, root), "fg_pct", ["season"]).select(
        "season", "total", "missing", F.round("pct", 6).alias("pct")
    )


@query("a12_ordinal_range", """
SELECT position, CAST(min(season * 100 + week) AS BIGINT) AS earliest, CAST(max(season * 100 + week) AS BIGINT) AS latest
FROM order_games GROUP BY position""", ["order_games"])
def a12(spark, root):
    t = F.col("season") * 100 + F.col("week")
    return src.order_games(spark, root).groupBy("position").agg(
        F.min(t).cast("bigint").alias("earliest"), F.max(t).cast("bigint").alias("latest")
    )


@query("a13_flag_histogram", """
SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN c_acctbal < 0 THEN 'overdrawn' END,
  CASE WHEN c_acctbal > 5000 THEN 'rich' END, CASE WHEN c_nationkey < 5 THEN 'low_nation' END],
  lambda x: x IS NOT NULL)) AS flag FROM customer) GROUP BY flag""")
def a13(spark, root):
    flags = nx.set_flags({
        "overdrawn": F.col("c_acctbal") < 0, "rich": F.col("c_acctbal") > 5000,
        "low_nation": F.col("c_nationkey") < 5,
    })
    return nx.flag_histogram(src.table(spark, root, "customer").select(flags.alias("flags")), "flags")


@query("a14_value_counts", """
SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def a14(spark, root):
    return src.table(spark, root, "orders").groupBy(F.col("o_orderstatus").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- sorts and top-k --------------------------------------------------------------
@query("t01_multi_key_sort", """
SELECT player_id, season, week, team FROM order_games ORDER BY player_id, season, week""", ["order_games"])
def t01(spark, root):
    return src.order_games(spark, root).select("player_id", "season", "week", "team").orderBy(
        "player_id", "season", "week"
    )


@query("t02_global_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def t02(spark, root):
    return setops.top_n(src.table(spark, root, "orders").select("o_orderkey", "o_totalprice"),
                        ["o_totalprice"], 100, ["o_orderkey"])


@query("t03_per_key_top_k", """
SELECT player_id, season, week, back FROM (SELECT *, row_number() OVER
  (PARTITION BY player_id ORDER BY season DESC, week DESC) AS back FROM order_games) WHERE back <= 3""", ["order_games"])
def t03(spark, root):
    top = setops.top_per_key(src.order_games(spark, root), ["player_id"], ["season", "week"], 3, rank="back")
    return top.select("player_id", "season", "week", F.col("back").cast("bigint").alias("back"))


@query("t04_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def t04(spark, root):
    o = src.table(spark, root, "orders")
    return setops.best_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("t05_top_n_by_score", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def t05(spark, root):
    return setops.top_n(src.table(spark, root, "part").select("p_partkey", "p_retailprice"),
                        ["p_retailprice"], 10, ["p_partkey"])


# --- set operations -----------------------------------------------------------------
@query("u01_merged_lists", """
SELECT o_custkey, array_to_string(list_sort(list_distinct(list_concat(
  list(o_orderstatus) FILTER (year(o_orderdate) < 1998), list(o_orderstatus) FILTER (year(o_orderdate) >= 1998)))), ',') AS merged
FROM orders GROUP BY o_custkey""")
def u01(spark, root):
    o = src.order_periods(spark, root)
    early = F.collect_set(F.when(F.col("season") < 1998, F.col("o_orderstatus")))
    late = F.collect_set(F.when(F.col("season") >= 1998, F.col("o_orderstatus")))
    both = o.groupBy("o_custkey").agg(early.alias("a"), late.alias("b"))
    return both.select("o_custkey", F.array_join(nx.merge_lists("a", "b"), ",").alias("merged"))


@query("u02_set_difference", """
SELECT DISTINCT o_custkey, season, week FROM order_periods
EXCEPT SELECT o_custkey, season + 1, week FROM order_periods""", ["order_periods"])
def u02(spark, root):
    o = src.order_periods(spark, root)
    # every season against the one before
    before = o.withColumn("season", F.col("season") + 1)
    return setops.missing_keys(o, before, ["o_custkey", "season", "week"])


@query("u03_append_paths", """
SELECT player_id, season, 'orders' AS path FROM order_games WHERE season >= 1998
UNION ALL SELECT player_id, season, 'fallback' FROM order_games WHERE season < 1998""", ["order_games"])
def u03(spark, root):
    g = src.order_games(spark, root).select("player_id", "season")
    late = g.filter(F.col("season") >= 1998).withColumn("path", F.lit("orders"))
    early = g.filter(F.col("season") < 1998).select(F.lit("fallback").alias("path"), "season", "player_id")
    return late.unionByName(early)


# --- catalog and views ----------------------------------------------------------------
_CATALOG = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "labels",
    "documents", "pages", "benchmark", "conversations",
]


@query("s09_catalog_summary", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS column_count" for t in _CATALOG))
def s09(spark, root):
    out = views.catalog_summary({t: src.table(spark, root, t) for t in _CATALOG})
    return out.select("table_name", F.col("rows").alias("row_count"), F.col("columns").alias("column_count"))


@query("s10_current_players", """
SELECT player_id, player_name, position, team, season, max(week) AS latest_week FROM order_games
WHERE season = (SELECT max(season) FROM order_games) GROUP BY ALL""", ["order_games"])
def s10(spark, root):
    return views.current_players(src.order_games(spark, root))


@query("s11_latest_rosters", """
SELECT DISTINCT team, position, player_id, player_name FROM order_games WHERE season = (SELECT max(season) FROM order_games)""",
       ["order_games"])
def s11(spark, root):
    return views.latest_rosters(src.order_games(spark, root))


@query("s11_roster_counts", """
SELECT team, position, count(*) AS player_count FROM (SELECT DISTINCT team, position, player_id, player_name FROM order_games
  WHERE season = (SELECT max(season) FROM order_games)) GROUP BY team, position""", ["order_games"])
def s11_counts(spark, root):
    return views.roster_counts(views.latest_rosters(src.order_games(spark, root)))


@query("s12_season_summary", """
SELECT season, count(DISTINCT player_id) AS players, count(DISTINCT team) AS teams, max(week) AS max_week, count(*) AS row_count
FROM order_games GROUP BY season""", ["order_games"])
def s12(spark, root):
    return views.season_summary(src.order_games(spark, root)).withColumnRenamed("rows", "row_count")


@query("s13_team_roster_lookup", """
SELECT DISTINCT player_id, player_name, position, team FROM order_games WHERE team = 4 AND season = 2000 AND week = 3""",
       ["order_games"])
def s13(spark, root):
    return views.team_roster(src.order_games(spark, root), 4, 2000, 3)


@query("s14_position_summary", """
SELECT player_id, player_name, team, position, count(*) AS games_played, round(avg(fantasy_points), 6) AS avg_fantasy_points
FROM order_games WHERE position = 'QB' AND season = 1999 GROUP BY ALL""", ["order_games"])
def s14(spark, root):
    out = views.position_summary(src.order_games(spark, root), "QB", 1999)
    return out.withColumn("avg_fantasy_points", F.round("avg_fantasy_points", 6))
