"""Sources, sinks and idempotent loading: s01-s08, i01-i08."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekfold import config, schemas
from weekfold.operators import ingest as ing
from weekfold.operators import keys
from weekfold.queries import stages
from weekfold.queries.features import rounded
from weekfold.queries.registry import query
from weekfold.session import scratch_path, settle
from weekfold.sources import feeds, sinks
from weekfold.sources import stand_ins as src
from weekfold.streaming import incremental as stream


def _write_feed(spark, root, feed, df, fmt="parquet"):
    """Lay a feed out by season the way load_feeds expects it; returns the feed root."""
    base = scratch_path(spark, "feeds")
    writer = df.write.partitionBy("season") if "season" in df.columns else df.write
    writer = writer.option("header", "true") if fmt == "csv" else writer
    writer.format(fmt).save(f"{base}/{feed}")
    return base


def _stats_feed(spark, root):
    ids = src.order_games(spark, root)
    return sinks.align(
        ids.withColumn("season", F.col("season") + 25), schemas.RAW["raw_player_stats"]
    )


@query("s01_seasonal_feed_scan", """
SELECT CAST(player_id AS VARCHAR) AS player_id, season + 25 AS season, week, season_type, fantasy_points FROM order_games WHERE season + 25 IN (2021, 2023)""",
       ["order_games"])
def s01(spark, root):
    base = _write_feed(spark, root, "player_stats", _stats_feed(spark, root))
    loaded = feeds.load_feeds(spark, base, [2021, 2023], feeds=["player_stats"])["raw_player_stats"]
    return loaded.select("player_id", "season", "week", "season_type", "fantasy_points")


@query("s01_csv_feed_scan", """
SELECT CAST(player_id AS VARCHAR) AS player_id, season + 25 AS season, week, team, fantasy_points FROM order_games WHERE season + 25 IN (2022)""",
       ["order_games"])
def s01_csv(spark, root):
    named = _stats_feed(spark, root)
    base = _write_feed(spark, root, "player_stats", named, "csv")
    loaded = feeds.load_feeds(spark, base, [2022], feeds=["player_stats"], fmt="csv")["raw_player_stats"]
    return loaded.select("player_id", "season", "week", F.col("team").cast("int").alias("team"), "fantasy_points")


def _gate_sql():
    rows = []
    for feed, (first, last, once) in config.FEED_SEASONS.items():
        test = "season = (SELECT min(season) FROM s)" if once else " AND ".join(
            [*([f"season >= {first}"] if first else []), *([f"season <= {last}"] if last else [])]
        ) or "true"
        rows.append(f"SELECT season, '{feed}' AS feed, {test} AS available FROM s")
    return "WITH s AS (SELECT DISTINCT season + 25 AS season FROM order_periods)\n" + "\nUNION ALL ".join(rows)


@query("s02_season_gate", _gate_sql(), ["order_periods"])
def s02(spark, root):
    seasons = src.order_periods(spark, root).select((F.col("season") + 25).alias("season"))
    return feeds.availability(seasons)


@query("s03_typed_schema", """
SELECT CAST(player_id AS VARCHAR) AS player_id, player_name, season, week, CAST(carries AS INTEGER) AS carries, CAST(rushing_yards AS INTEGER) AS rushing_yards,
  round(fg_pct, 6) AS fg_pct FROM player_games""", ["player_games"])
def s03(spark, root):
    typed = sinks.align(src.player_games(spark, root), schemas.RAW["raw_player_stats"])
    return typed.select("player_id", "player_name", "season", "week", "carries", "rushing_yards",
                        F.round("fg_pct", 6).alias("fg_pct"))


def _planted(schema):
    """(name, type, SQL of its text) for each column: a number or a name, and in every 97th row of a number "n/a"."""
    out = []
    for j, f in enumerate(schema):
        kind = f.dataType.simpleString()
        bad = f"(o_orderkey + {j}) % 97 = 0"
        if kind == "string":
            out.append((f.name, kind, "concat('s', o_orderkey)"))
        elif kind in ("date", "timestamp"):
            out.append((f.name, kind, f"CASE WHEN {bad} THEN 'n/a' ELSE '2020-01-02' END"))
        elif kind == "boolean":
            out.append((f.name, kind, f"CASE WHEN {bad} THEN 'n/a' ELSE 'true' END"))
        else:
            out.append((f.name, kind, f"CASE WHEN {bad} THEN 'n/a' ELSE cast(o_orderkey % 50 AS string) END"))
    return out


def _refusals_sql():
    parts = []
    for name, schema in schemas.RAW.items():
        checked = [j for j, f in enumerate(schema) if f.dataType.simpleString() != "string"]
        hits = " + ".join(f"CAST((o_orderkey + {j}) % 97 = 0 AS BIGINT)" for j in checked) or "0"
        parts.append(
            f"SELECT '{name}' AS table_name, {len(schema)}::BIGINT AS columns, count(*) AS row_count, "
            f"count(*) FILTER (({hits}) = 0) AS fitting_rows, CAST(sum({hits}) AS BIGINT) AS refused_cells, "
            f"CAST(sum({sum(1 for _ in checked)} - ({hits})) AS BIGINT) AS typed_cells FROM orders"
        )
    return "\nUNION ALL ".join(parts)


@query("s03_refused_cells", _refusals_sql())
def s03_refused(spark, root):
    """All raw tables from text with cells that do not fit: what is typed, what is refused."""
    orders = src.table(spark, root, "orders").select("o_orderkey")
    found = []
    for name, schema in schemas.RAW.items():
        text = orders.selectExpr(*[f"{e} AS `{c}`" for c, _, e in _planted(schema)])
        judged = feeds.with_refusals(text, schema)
        checked = [c for c, kind, _ in _planted(schema) if kind != "string"]
        typed = sum((F.col(f"`{c}`").isNotNull().cast("bigint") for c in checked), F.lit(0))
        found.append(judged.agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("refused") == 0).alias("fitting_rows"),
            F.sum(F.size("refused")).alias("refused_cells"), F.sum(typed).alias("typed_cells"),
        ).select(F.lit(name).alias("table_name"), F.lit(len(schema)).cast("bigint").alias("columns"), "*"))
    return reduce(DataFrame.unionByName, found)


@query("s04_season_filter", """
SELECT game_id, season, week FROM schedule WHERE season IN (1996, 1999)""", ["schedule"])
def s04(spark, root):
    return feeds.season_filter(src.schedule(spark, root), [1996, 1999]).select("game_id", "season", "week")


@query("s05_derived_key", "SELECT gsis_id, espn_id, gsis_id AS player_id FROM players", ["players"])
def s05(spark, root):
    return feeds.with_entity_key(src.players(spark, root).select("gsis_id", "espn_id"))


@query("s06_aligned_append", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
UNION ALL SELECT CAST(s_suppkey AS INTEGER), s_name, NULL FROM supplier""")
def s06(spark, root):
    target = src.table(spark, root, "nation")
    extra = src.table(spark, root, "supplier").select(
        F.col("s_name").alias("n_name"), "s_acctbal", F.col("s_suppkey").alias("n_nationkey")
    )
    return sinks.append_aligned(target, extra)


@query("s07_write_modes", """
SELECT season, count(*) * 2 AS row_count FROM order_periods WHERE season >= 1998 GROUP BY season
UNION ALL SELECT season, count(*) FROM order_periods WHERE season < 1998 GROUP BY season""", ["order_periods"])
def s07(spark, root):
    rows = src.order_periods(spark, root).select("o_orderkey", "season")
    schema = rows.schema
    path = scratch_path(spark, "modes")
    sinks.write_aligned(rows, path, schema, "fail")  # empty target: allowed
    sinks.write_aligned(rows, path, schema, "replace")
    sinks.write_aligned(rows.filter(F.col("season") >= 1998), path, schema, "append")
    return spark.read.schema(schema).parquet(path).groupBy("season").agg(F.count(F.lit(1)).alias("row_count"))


@query("s08_full_refresh", """
SELECT player_id, season, week, orders FROM order_games""", ["order_games"])
def s08(spark, root):
    rows = src.order_games(spark, root).select("player_id", "season", "week", "orders")
    path = scratch_path(spark, "refresh")
    sinks.refresh(rows, path)
    return sinks.refresh(rows, path)  # rebuilding replaces, never doubles


# --- loading --------------------------------------------------------------------------
_KEY_SQL = """md5('{"season": ' || season || ', "season_type": "' || season_type || '", "week": ' || week || '}')"""


@query("i01_row_key_hash", """
SELECT o_orderkey, o_custkey, md5('{' || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '"o_custkey": ' || o_custkey || ', ' END
  || '"o_orderkey": ' || o_orderkey || ', "o_orderstatus": "' || o_orderstatus || '"}') AS row_hash FROM orders""")
def i01(spark, root):
    o = src.table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    holed = o.withColumn("o_custkey_set", F.col("o_custkey")).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey"))
    )
    hashed = ing.with_key_hash(holed, ["o_orderstatus", "o_orderkey", "o_custkey"])
    return hashed.select("o_orderkey", F.col("o_custkey_set").alias("o_custkey"), "row_hash")


@query("i02_key_selection", """
SELECT player_id, season, week, md5('{"player_id": ' || player_id || ', "season": ' || season || ', "season_type": "' || season_type || '", "week": ' || week || '}') AS by_table,
  md5('{"player_id": ' || player_id || ', "season": ' || season || ', "week": ' || week || '}') AS by_default FROM order_games""", ["order_games"])
def i02(spark, root):
    g = src.order_games(spark, root).select("player_id", "season", "week", "season_type")
    first = ing.with_key_hash(g, ing.key_columns(g, "raw_player_stats")).withColumnRenamed("row_hash", "by_table")
    both = ing.with_key_hash(first, ing.key_columns(first, "no_such_table")).withColumnRenamed("row_hash", "by_default")
    return both.select("player_id", "season", "week", "by_table", "by_default")


def _batches(spark, root):
    """Orders before 1999 are stored; the batch brings 1998 again and all later ones."""
    o = src.order_periods(spark, root).select("o_orderkey", "o_custkey", "season", "week")
    hashed = ing.with_key_hash(o, ["o_custkey", "season", "week"])
    return hashed.filter(F.col("season") < 1999), hashed.filter(F.col("season") >= 1998)


@query("i03_new_row_filter", """
SELECT o_orderkey, season, week FROM order_periods WHERE season >= 1998
  AND (o_custkey, season, week) NOT IN (SELECT (o_custkey, season, week) FROM order_periods WHERE season < 1999)""", ["order_periods"])
def i03(spark, root):
    stored, batch = _batches(spark, root)
    return ing.new_rows(batch, stored).select("o_orderkey", "season", "week")


@query("i03_stored_keys", """
SELECT o_orderkey, season, week FROM order_periods WHERE season >= 1998
  AND (o_custkey, season, week) NOT IN (SELECT (o_custkey, season, week) FROM order_periods WHERE season < 1999)""", ["order_periods"])
def i03_stored(spark, root):
    """Against keys that are stored in buckets: the plan shuffles the batch alone."""
    stored, batch = _batches(spark, root)
    known = stages.kept(
        spark, root, "order keys", lambda: keys.key_table(spark, scratch_path(spark, "order-keys"), stored, buckets=8)
    )
    return known.unseen(batch).select("o_orderkey", "season", "week")


@query("i04_batch_fingerprint", """
SELECT substr(sha256('(' || count(*) || ', 6)[''o_orderkey'', ''o_custkey'', ''o_orderstatus'', ''o_totalprice'', ''o_orderdate'', ''o_orderpriority'']' || count(*) * 6), 1, 16) AS batch_hash,
  count(*) AS row_count FROM orders""")
def i04(spark, root):
    return ing.fingerprint(src.table(spark, root, "orders")).withColumnRenamed("rows", "row_count")


@query("i04_content_fingerprint", """
SELECT substr(sha256(count(*) || ':' || sum(('0x' || substr(md5('{"cents": ' || CAST(round(o_totalprice * 100) AS BIGINT) || ', "o_custkey": ' || o_custkey
  || ', "o_orderdate": "' || strftime(o_orderdate, '%Y-%m-%d') || '", "o_orderkey": ' || o_orderkey || ', "o_orderpriority": "' || o_orderpriority
  || '", "o_orderstatus": "' || o_orderstatus || '"}'), 1, 12))::BIGINT)), 1, 16) AS content_hash, count(*) AS row_count FROM orders""")
def i04_content(spark, root):
    """Every column of every row; prices as whole cents and dates as text, which both engines spell alike."""
    return ing.content_fingerprint(_spelled(src.table(spark, root, "orders"))).withColumnRenamed("rows", "row_count")


def _spelled(orders):
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


@query("i04_changed_parts", """
WITH o AS (SELECT year(o_orderdate) AS season, o_orderkey % 16 AS bucket,
    o_orderkey % 5 = 0 AND year(o_orderdate) = 1997 AND o_orderkey % 16 IN (3, 4) AS altered,
    year(o_orderdate) = 1994 AND o_orderkey % 16 = 7 OR year(o_orderdate) = 1995 AS deleted FROM orders)
SELECT season, CAST(bucket AS INTEGER) AS bucket, count(*) AS old_rows, count(*) FILTER (NOT deleted) AS new_rows FROM o
GROUP BY season, bucket HAVING bool_or(altered OR deleted)""")
def i04_changed(spark, root):
    """Which partitions and buckets of orders differ between two loads: altered cells, a bucket and a season gone."""
    rows = _spelled(src.table(spark, root, "orders")).withColumn("season", F.substring("o_orderdate", 1, 4).cast("bigint"))
    key = F.col("o_orderkey")
    altered = (key % 5 == 0) & (F.col("season") == 1997) & (key % 16).isin(3, 4)
    deleted = ((F.col("season") == 1994) & (key % 16 == 7)) | (F.col("season") == 1995)
    later = rows.filter(~deleted).withColumn("cents", F.when(altered, F.col("cents") + 1).otherwise(F.col("cents")))
    trees = [settle(ing.hash_tree(x, ["season"], "o_orderkey", 16), "hash-tree") for x in (rows, later)]
    return ing.changed_parts(*trees, ["season"])


_COUNTERS = """
SELECT '{t}' AS table_name, count(*) AS total_rows, count(*) FILTER (season >= 1999) AS new_rows, 0::BIGINT AS updated_rows,
  count(*) FILTER (season = 1998) AS skipped_rows, 2.5::DOUBLE AS seconds, round(100.0 * count(*) FILTER (season >= 1999) / count(*), 6) AS efficiency
FROM order_periods WHERE season >= 1998"""


@query("i05_ingest_counters", _COUNTERS.format(t="orders"), ["order_periods"])
def i05(spark, root):
    stored, batch = _batches(spark, root)
    return rounded(ing.counters(ing.split_batch(batch, stored), "orders", 2.5))


@query("i05_incremental_append", """
SELECT season, count(*) AS row_count FROM order_periods GROUP BY season""", ["order_periods"])
def i05_append(spark, root):
    o = src.order_periods(spark, root).select("o_orderkey", "o_custkey", "season", "week")
    path, own = scratch_path(spark, "append"), ["o_orderkey", "season"]
    for batch in (o.filter(F.col("season") < 1999), o.filter(F.col("season") >= 1998), o.filter(F.col("season") >= 1999)):
        table, _ = ing.incremental_append(
            batch, path, "orders", own, partition_by=["season"], keys_path=f"{path}-keys"
        )
    return table.groupBy("season").agg(F.count(F.lit(1)).alias("row_count"))


@query("i06_hash_coverage", """
SELECT count(*) AS total_rows, count(DISTINCT (o_custkey, season, week)) AS unique_hashes,
  round(100.0 * count(DISTINCT (o_custkey, season, week)) / count(*), 6) AS hash_coverage FROM order_periods""", ["order_periods"])
def i06(spark, root):
    o = src.order_periods(spark, root).select("o_custkey", "season", "week")
    return rounded(ing.hash_coverage(ing.with_key_hash(o, ["o_custkey", "season", "week"])))


@query("i07_run_summary", """
SELECT count(*) AS total_operations, CAST(sum(t) AS BIGINT) AS total_rows_processed, CAST(sum(n) AS BIGINT) AS total_new_rows, 0::BIGINT AS total_updated_rows,
  CAST(sum(t - n) AS BIGINT) AS total_skipped_rows, round(100.0 * sum(n) / sum(t), 6) AS overall_efficiency,
  4.0::DOUBLE AS total_seconds, 0.5::DOUBLE AS operations_per_second
FROM (SELECT count(*) AS t, count(*) FILTER (season >= 1999) AS n FROM order_periods WHERE season >= 1998
      UNION ALL SELECT count(*), count(*) FROM customer)""", ["order_periods"])
def i07(spark, root):
    stored, batch = _batches(spark, root)
    people = ing.with_key_hash(src.table(spark, root, "customer").select("c_custkey"), ["c_custkey"])
    loads = ing.counters(ing.split_batch(batch, stored), "orders", 2.5).unionByName(
        ing.counters(ing.split_batch(people, None), "customer", 1.5)
    )
    return rounded(ing.run_summary(loads))


@query("i08_continuous_load", """
SELECT count(*) AS row_count, count(*) AS unique_hashes FROM orders""")
def i08(spark, root):
    keys = ["o_orderkey", "o_custkey"]
    schema = schemas.STAR["orders"]
    target = scratch_path(spark, "stream-table")
    # two independent runs over the same files: the second finds every key stored
    for run in range(2):
        stream.incremental_stream(
            spark, f"{root}/orders*.parquet", schema, target, keys, scratch_path(spark, f"stream-state-{run}")
        ).awaitTermination()
    return stream.load_counts(stream.stored_rows(spark, target, schema)).withColumnRenamed("rows", "row_count")


@query("i08_keyed_stream", """
SELECT year(o_orderdate) AS season, count(*) AS row_count, count(DISTINCT o_orderkey) AS unique_keys FROM orders GROUP BY 1""")
def i08_keyed(spark, root):
    """Three runs over files that come late and twice: each key is stored once, by the state of the stream."""
    orders = src.table(spark, root, "orders")
    keys_of = ["o_orderkey", "o_custkey"]
    waiting, target, state = (scratch_path(spark, n) for n in ("waiting", "keyed-table", "keyed-state"))
    late = F.col("o_orderkey") % 3 == 0
    for run in (orders.filter(~late), orders.filter(F.col("o_orderkey") % 2 == 0), orders):
        run.write.mode("append").parquet(waiting)
        stream.keyed_stream(spark, waiting, orders.schema, target, keys_of, state).awaitTermination()
    stored = spark.read.parquet(target)
    return stored.groupBy(F.year("o_orderdate").cast("bigint").alias("season")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_orderkey").alias("unique_keys")
    )
