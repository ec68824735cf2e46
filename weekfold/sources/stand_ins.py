"""The feature tables, derived from the star-schema test tables.

Every adapter aggregates before it joins: order lines collapse to one row per
order, orders to one row per customer and month, and only then are customer
attributes attached. A customer or order holding a large share of all rows is
reduced by map-side combine before it reaches a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekfold import schemas

TEAMS = 25
POST_WEEK = 12
SEGMENT_POSITION = {
    "AUTOMOBILE": "QB",
    "BUILDING": "RB",
    "FURNITURE": "WR",
    "HOUSEHOLD": "TE",
    "MACHINERY": "K",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One test table, read with its declared schema (never inferred)."""
    return spark.read.schema(schemas.STAR[name]).parquet(f"{root}/{name}.parquet")


def _position(segment: str) -> Column:
    out = F
    for text, position in SEGMENT_POSITION.items():
        out = out.when(F.col(segment) == text, F.lit(position))
    return out.otherwise(F.lit("DEF"))


def _season_type(week: str = "week") -> Column:
    return F.when(F.col(week) == POST_WEEK, F.lit("POST")).otherwise(F.lit("REG"))


def opponent(team: str = "team", week: str = "week") -> Column:
    return F.pmod(F.col(week) - F.col(team), F.lit(TEAMS))


def order_periods(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").cast("int").alias("season"),
        F.month("o_orderdate").cast("int").alias("week"),
        # whole thousands: sums of them are exact in any order
        F.floor(F.col("o_totalprice") / 1000).alias("points"),
    )


# quarters between -1.25 and 1.25, so that sums are exact in any order
_EPA = "(round(l_discount * 100) - 5) / 4"
# per order: name -> aggregate over its lines
_LINE_MEASURES = {
    "lines": "count(1)",
    "quantity": "sum(l_quantity)",
    "attempts": "count_if(l_returnflag <> 'R')",
    "completions": "count_if(l_returnflag <> 'R' AND l_linestatus = 'O')",
    "passing_yards": "sum(if(l_returnflag <> 'R', l_quantity, 0D))",
    "passing_tds": "count_if(l_returnflag <> 'R' AND l_quantity > 45)",
    "passing_interceptions": "count_if(l_returnflag <> 'R' AND l_suppkey % 20 = 0)",
    "passing_epa": f"sum(if(l_returnflag <> 'R', {_EPA}, 0D))",
    "sacks_suffered": "count_if(l_returnflag <> 'R' AND round(l_discount * 100) = 10)",
    "carries": "count_if(l_returnflag = 'R')",
    "rushing_yards": "sum(if(l_returnflag = 'R', l_quantity, 0D))",
    "rushing_tds": "count_if(l_returnflag = 'R' AND l_quantity > 45)",
    "rushing_epa": f"sum(if(l_returnflag = 'R', {_EPA}, 0D))",
    "targets": "count_if(l_returnflag = 'N')",
    "receptions": "count_if(l_returnflag = 'N' AND l_linestatus = 'O')",
    "receiving_yards": "sum(if(l_returnflag = 'N' AND l_linestatus = 'O', l_quantity, 0D))",
    "receiving_tds": "count_if(l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity > 45)",
    "receiving_epa": f"sum(if(l_returnflag = 'N', {_EPA}, 0D))",
    "fg_att": "count_if(l_partkey % 3 = 0)",
    "fg_made": "count_if(l_partkey % 3 = 0 AND l_linestatus = 'O')",
    "pat_att": "count_if(l_partkey % 4 = 0)",
    "pat_made": "count_if(l_partkey % 4 = 0 AND l_linestatus <> 'O')",
    "def_tackles_solo": "count_if(l_suppkey % 2 = 0)",
}


AMOUNTS = [
    "quantity", "passing_yards", "passing_epa", "rushing_yards", "rushing_epa",
    "receiving_yards", "receiving_epa",
]
COUNTS = [m for m in _LINE_MEASURES if m not in AMOUNTS]
RATES = ["fg_pct", "target_share", "air_yards_share"]
# the statistics of player_games that the position lists ask for
STATS = [c for c in COUNTS if c != "lines"] + [c for c in AMOUNTS if c != "quantity"] + RATES


def player_games(spark: SparkSession, root: str) -> DataFrame:
    """One row per (player, season, week) with all game statistics; byes dropped."""
    lines = table(spark, root, "lineitem").groupBy("l_orderkey").agg(
        *[F.expr(f"{sql} AS {name}") for name, sql in _LINE_MEASURES.items()]
    )
    orders = order_periods(spark, root)
    games = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_custkey", "season", "week")
        .agg(
            F.sum("o_totalprice").alias("spend"),
            F.sum("points").cast("double").alias("fantasy_points"),
            F.count(F.lit(1)).alias("orders"),
            *[F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in COUNTS],
            *[F.expr(f"coalesce(sum({c}), 0D) AS {c}") for c in AMOUNTS],
        )
    )
    people = table(spark, root, "customer").select(
        "c_custkey",
        F.col("c_name").alias("player_name"),
        _position("c_mktsegment").alias("position"),
        F.col("c_nationkey").alias("team"),
    )
    joined = games.join(people, games.o_custkey == people.c_custkey).withColumn(
        "opponent_team", opponent()
    )
    return joined.filter(F.col("opponent_team") != F.col("team")).select(
        F.col("o_custkey").alias("player_id"),
        "player_name", "position", "season", "week",
        _season_type().alias("season_type"),
        "team", "opponent_team", "orders", "spend",
        *COUNTS, *AMOUNTS,
        (F.col("fg_made") / F.nullif(F.col("fg_att"), F.lit(0))).alias("fg_pct"),
        (F.col("targets") / F.nullif(F.col("lines"), F.lit(0))).alias("target_share"),
        F.try_divide("receiving_yards", F.nullif(F.col("quantity"), F.lit(0.0))).alias("air_yards_share"),
        "fantasy_points",
        (F.col("fantasy_points") + F.col("receptions")).alias("fantasy_points_ppr"),
    )


def order_games(spark: SparkSession, root: str) -> DataFrame:
    """``player_games`` without line statistics: one row per player and period."""
    games = order_periods(spark, root).groupBy("o_custkey", "season", "week").agg(
        F.sum("o_totalprice").alias("spend"),
        F.sum("points").cast("double").alias("fantasy_points"),
        F.count(F.lit(1)).alias("orders"),
        F.min("o_orderstatus").alias("first_status"),
    )
    people = table(spark, root, "customer").select(
        "c_custkey",
        F.col("c_name").alias("player_name"),
        _position("c_mktsegment").alias("position"),
        F.col("c_nationkey").alias("team"),
    )
    joined = games.join(people, games.o_custkey == people.c_custkey).withColumn(
        "opponent_team", opponent()
    )
    return joined.select(
        F.col("o_custkey").alias("player_id"),
        "player_name", "position", "season", "week",
        _season_type().alias("season_type"),
        "team", "opponent_team", "orders", "spend", "first_status", "fantasy_points",
    )


def team_stats(spark: SparkSession, root: str) -> DataFrame:
    return team_totals(player_games(spark, root))


def team_totals(games: DataFrame) -> DataFrame:
    """player_games summed per (team, season, week)."""
    return games.groupBy(
        "team", "season", "week", "season_type", "opponent_team"
    ).agg(
        *[F.expr(f"sum({c}) AS {c}") for c in [*COUNTS, *AMOUNTS] if c not in ("lines", "quantity")],
        F.sum("fantasy_points").alias("fantasy_points"),
    )


def team_games_source(spark: SparkSession, root: str) -> DataFrame:
    """Every non-bye team-week: opponent, rest, division flag, points scored.

    Sized by teams x periods, whatever the number of orders.
    """
    scored = (
        order_periods(spark, root).groupBy("o_custkey", "season", "week")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    home = table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").alias("team"))
    points = (
        scored.join(home, scored.o_custkey == home.c_custkey)
        .groupBy("team", "season", "week").agg(F.sum("n").cast("bigint").alias("points"))
    )
    nation = table(spark, root, "nation")
    region = nation.select(F.col("n_nationkey").alias("team"), F.col("n_regionkey").alias("region"))
    against = nation.select(
        F.col("n_nationkey").alias("opponent_team"), F.col("n_regionkey").alias("against_region")
    )
    grid = (
        order_periods(spark, root).select("season", "week").distinct()
        .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(TEAMS - 1))))
        .withColumn("opponent_team", opponent())
        .filter(F.col("opponent_team") != F.col("team"))
    )
    gap = F.col("week") - F.lag("week").over(Window.partitionBy("team", "season").orderBy("week"))
    return (
        grid.join(region, "team").join(against, "opponent_team")
        .join(points, ["team", "season", "week"], "left")
        .select(
            "team", "season", "week", "opponent_team",
            (gap * 7).alias("rest"),
            (F.col("region") == F.col("against_region")).cast("int").alias("div_game"),
            F.coalesce("points", F.lit(0)).alias("points"),
        )
    )


def schedule(spark: SparkSession, root: str) -> DataFrame:
    """One row per game; the lower team key is at home."""
    sides = team_games_source(spark, root)
    home = sides.filter(F.col("team") < F.col("opponent_team")).select(
        "season", "week", F.col("team").alias("home_team"), F.col("opponent_team").alias("away_team"),
        F.col("points").alias("home_score"), F.col("rest").alias("home_rest"), "div_game",
    )
    away = sides.filter(F.col("team") > F.col("opponent_team")).select(
        "season", "week", F.col("team").alias("away_team"),
        F.col("points").alias("away_score"), F.col("rest").alias("away_rest"),
    )
    return home.join(away, ["season", "week", "away_team"]).select(
        F.concat_ws("_", "season", "week", "home_team", "away_team").alias("game_id"),
        "season",
        F.when(F.col("week") == POST_WEEK, F.lit("POST")).otherwise(F.lit("REG")).alias("game_type"),
        "week",
        F.make_date(F.col("season"), F.col("week"), F.col("home_team") % 7 + 1).alias("gameday"),
        "home_team", "home_score", "home_rest",
        "away_team", "away_score", "away_rest", "div_game",
    )


def plays(spark: SparkSession, root: str) -> DataFrame:
    """One row per order line, seen as a play of the customer's team."""
    lines = table(spark, root, "lineitem")
    sizes = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("drive_play_count"))
    people = table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").alias("posteam"))
    drives = (
        order_periods(spark, root).select("o_orderkey", "o_custkey", "season", "week")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("defteam", opponent("posteam"))
        .filter(F.col("defteam") != F.col("posteam"))
        .join(sizes.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
        # text that only depends on the order is built once per order, not per line
        .select(
            "o_orderkey", "season", "week", _season_type().alias("season_type"), "posteam", "defteam",
            "drive_play_count",
            F.concat_ws(
                "_", "season", "week", F.least("posteam", "defteam"), F.greatest("posteam", "defteam")
            ).alias("game_id"),
            F.concat(
                (F.col("o_orderkey") % 8).cast("string"), F.lit(":"),
                F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"),
            ).alias("drive_time_of_possession"),
        )
    )
    ran = F.col("l_returnflag") == "R"
    success = (F.col("l_linestatus") == "O").cast("int")
    cents = F.round(F.col("l_discount") * 100).cast("int")
    third = F.col("l_linenumber") == 3
    return lines.join(drives, lines.l_orderkey == drives.o_orderkey).select(
        "game_id", "season", "week", "season_type", "posteam", "defteam",
        F.col("l_orderkey").alias("drive"), "drive_play_count", "drive_time_of_possession",
        F.col("l_linenumber").alias("down"),
        F.col("l_quantity").alias("yards_gained"),
        F.col("l_quantity").alias("yardline_100"),
        F.expr(_EPA).alias("epa"),
        success.alias("success"),
        ran.cast("int").alias("touchdown"),
        F.when(ran, F.lit("run")).otherwise(F.lit("pass")).alias("play_type"),
        F.lit(1).alias("play"),
        (~ran).cast("int").alias("pass_attempt"),
        ran.cast("int").alias("rush_attempt"),
        (cents >= 9).cast("int").alias("qb_hit"),
        (cents == 10).cast("int").alias("sack"),
        (F.col("l_suppkey") % 20 == 0).cast("int").alias("interception"),
        (F.col("l_partkey") % 25 == 0).cast("int").alias("fumble_lost"),
        (third & (success == 1)).cast("int").alias("third_down_converted"),
        (third & (success == 0)).cast("int").alias("third_down_failed"),
        (F.round(F.col("l_tax") * 200).cast("int") - 8).alias("score_differential"),
        (F.col("l_partkey") % 900).cast("int").alias("quarter_seconds_remaining"),
    )


def rosters(spark: SparkSession, root: str) -> DataFrame:
    """Who was on which team in which week."""
    status = (
        F.when(F.col("first_status") == "O", F.lit("ACT"))
        .when(F.col("first_status") == "F", F.lit("RES"))
        .otherwise(F.lit("CUT"))
    )
    return order_games(spark, root).select(
        "season", "team", "week",
        F.col("player_id").alias("gsis_id"),
        F.col("player_name").alias("full_name"),
        "position", F.col("position").alias("depth_chart_position"),
        (F.col("player_id") % 99 + 1).cast("int").alias("jersey_number"),
        status.alias("status"),
        (F.col("season") - 1995).alias("years_exp"),
        (F.lit(66) + F.col("player_id") % 15).cast("string").alias("height"),
        (F.lit(170) + F.col("player_id") % 150).cast("int").alias("weight"),
    )


def depth_charts(spark: SparkSession, root: str) -> DataFrame:
    """One row per roster row of every week but the first of each season."""
    return rosters(spark, root).filter(F.col("week") > 1).select(
        "season", F.col("team").alias("club_code"), "week",
        (F.lit(1) + F.col("gsis_id") % 3).cast("string").alias("depth_team"),
        F.split_part("full_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.split_part("full_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.lit("Offense").alias("formation"),
        "gsis_id", "position",
    )


def players(spark: SparkSession, root: str) -> DataFrame:
    """Player metadata from customers."""
    nation = table(spark, root, "nation").select("n_nationkey", "n_name")
    c = table(spark, root, "customer")
    position = _position("c_mktsegment")
    return c.join(nation, c.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_custkey").alias("gsis_id"),
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("espn_id"),
        F.col("c_name").alias("player_name"),
        position.alias("position"),
        F.when(F.col("c_custkey") % 3 != 0, position).alias("position_group"),
        (F.lit(1995) + F.col("c_custkey") % 4).cast("int").alias("draft_year"),
        (F.lit(1) + F.col("c_custkey") % 7).cast("int").alias("draft_round"),
        (F.lit(1) + F.col("c_custkey") % 32).cast("int").alias("draft_pick"),
        F.col("n_name").alias("college"),
        F.when(F.col("c_acctbal") < 0, F.lit("RET")).otherwise(F.lit("ACT")).alias("status"),
    )
