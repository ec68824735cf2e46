"""Table-level audits: q07, q08, q10-q12, q14."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekfold.operators import lifecycle, quality, summaries
from weekfold.queries.features import lifecycles, rounded
from weekfold.queries.registry import query
from weekfold.session import settle
from weekfold.sources import stand_ins as src


@query("q07_z_score_outliers", """
SELECT player_id, season, week, fantasy_points, round(z, 6) AS z_score FROM (
  SELECT *, abs((fantasy_points - (SELECT avg(fantasy_points) FROM order_games)) / (SELECT stddev_samp(fantasy_points) FROM order_games)) AS z FROM order_games)
WHERE z > 3.0 ORDER BY z DESC, player_id, season, week LIMIT 100""", ["order_games"])
def q07(spark, root):
    g = src.order_games(spark, root).select("player_id", "season", "week", "fantasy_points")
    out = quality.zscore_outliers(g, "fantasy_points", 3.0, 100, ["player_id", "season", "week"])
    return out.withColumn("z_score", F.round("z_score", 6))


@query("q08_table_completeness", """
SELECT count(*) AS total_records, count(DISTINCT player_id) AS unique_players, count(DISTINCT season) AS seasons_covered,
  CAST(min(season) AS BIGINT) AS earliest_season, CAST(max(season) AS BIGINT) AS latest_season FROM order_games""", ["order_games"])
def q08(spark, root):
    return rounded(quality.completeness(src.order_games(spark, root)))


_SUMMARISED = ["player_id", "season", "week", "fantasy_points", "player_name"]


@query("q08_from_summaries", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER ({c} IS NULL) AS nulls, "
    + (f"CAST(min({c}) AS DOUBLE) AS low_number, CAST(max({c}) AS DOUBLE) AS high_number, true AS median_close, "
       if c != "player_name" else "NULL AS low_number, NULL AS high_number, NULL AS median_close, ")
    + "true AS distinct_close FROM order_games" for c in _SUMMARISED), ["order_games"])
def q08_summaries(spark, root):
    """From sketches of single seasons alone: counts and extremes exact, distinct counts and medians within 3 %."""
    rows = src.order_games(spark, root)
    parted = rows.withColumn("part", F.col("season"))
    stored = settle(summaries.summarise(parted, _SUMMARISED, ["part"], "first"), "summaries")
    found = summaries.unite(stored).withColumn("median", summaries.quantile("quantile_sketch", 0.5))
    # what the estimates are held against
    numbers = [c for c in _SUMMARISED if c != "player_name"]
    exact = rows.agg(*[F.count_distinct(c).alias(f"d_{c}") for c in _SUMMARISED]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("exact")) for c in _SUMMARISED
    ])).alias("e")).select("e.*")
    # the share of rows up to the median
    held = found.where("median is not null").select("column", "median")
    below = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in numbers
    ])).alias("e")).select("e.*").join(F.broadcast(held), "column").groupBy("column").agg(
        F.avg((F.col("value") < F.col("median")).cast("double")).alias("under"),
        F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"),
    )
    return found.join(exact, "column").join(below, "column", "left").select(
        "column", "n", "nulls", "low_number", "high_number",
        ((F.col("under") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_close"),
        (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(0.03 * F.col("exact"), F.lit(0))).alias("distinct_close"),
    )


@query("q10_lifecycle_validation", """
SELECT 'null_player_id' AS check_name, count(*) FILTER (player_id IS NULL) AS violations FROM lifecycle
UNION ALL SELECT 'span_reversed', count(*) FILTER (last_season < first_season) FROM lifecycle
UNION ALL SELECT 'season_out_of_range', count(*) FILTER (first_season NOT BETWEEN 1990 AND 2030 OR last_season NOT BETWEEN 1990 AND 2030) FROM lifecycle
UNION ALL SELECT 'duplicate_keys', count(*) - count(DISTINCT player_id) FROM lifecycle""", ["lifecycle"])
def q10(spark, root):
    return quality.validate_lifecycle(lifecycles(spark, root))


@query("q11_snapshot_validation", """
WITH s AS (SELECT team, season, week, count(*) AS members FROM rosters WHERE status IN ('ACT', 'RES') GROUP BY 1, 2, 3)
SELECT 'bad_team_code' AS check_name, count(*) FILTER (length(CAST(team AS VARCHAR)) NOT BETWEEN 1 AND 3) AS violations FROM s
UNION ALL SELECT 'week_out_of_range', count(*) FILTER (week NOT BETWEEN 1 AND 22) FROM s
UNION ALL SELECT 'no_members', count(*) FILTER (members < 1) FROM s
UNION ALL SELECT 'duplicate_keys', 0""", ["rosters"])
def q11(spark, root):
    return quality.validate_snapshots(lifecycle.snapshot_index(
        src.rosters(spark, root), src.schedule(spark, root), src.depth_charts(spark, root)
    ))


@query("q12_classification_validation", """
SELECT 'unknown_category' AS check_name, count(*) FILTER (category NOT IN ('rookie', 'developing', 'veteran')) AS violations FROM experience
UNION ALL SELECT 'unknown_strategy', 0
UNION ALL SELECT 'played_below_one', count(*) FILTER (seasons_played < 1) FROM experience
UNION ALL SELECT 'confidence_out_of_range', 0
UNION ALL SELECT 'band_mismatch', count(*) FILTER (category <> CASE WHEN seasons_played <= 1 THEN 'rookie' WHEN seasons_played <= 3 THEN 'developing' ELSE 'veteran' END) FROM experience
UNION ALL SELECT 'duplicate_keys', count(*) - count(DISTINCT (player_id, season)) FROM experience""", ["experience"])
def q12(spark, root):
    return quality.validate_experience(lifecycle.experience(src.player_games(spark, root), lifecycles(spark, root)))


@query("q14_input_preconditions", """
SELECT 'orders' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) = 0 FROM lineitem
UNION ALL SELECT 'no_open_orders', count(*), count(*) = 0 FROM orders WHERE o_orderstatus = 'X'""")
def q14(spark, root):
    frames = {
        "orders": src.table(spark, root, "orders"), "lineitem": src.table(spark, root, "lineitem"),
        "no_open_orders": src.table(spark, root, "orders").filter(F.col("o_orderstatus") == "X"),
    }
    quality.check_inputs(frames, list(frames))
    return quality.input_counts(frames)
