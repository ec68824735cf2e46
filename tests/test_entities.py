"""Lifecycles, snapshots, experience, feeds and scalar helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekfold.functions import nested as nx
from weekfold.functions import scalars as fx
from weekfold.operators import lifecycle
from weekfold import schemas
from weekfold.sources import feeds, sinks


def players(spark):
    return spark.createDataFrame(
        [("p1", "g1", None, "QB", "ACT"), ("p2", "g2", "RB", "HB", "RET"), ("p3", "g3", None, "WR", "ACT"),
         ("p4", "g4", None, "TE", "ACT")],
        "player_id string, gsis_id string, position_group string, position string, status string",
    ).selectExpr("*", "gsis_id AS espn_id", "2000 AS draft_year", "1 AS draft_round", "1 AS draft_pick", "'X' AS college")


def rosters(spark):
    data = [
        ("g1", "KC", 2021, 1, "ACT"), ("g1", "KC", 2021, 2, "ACT"), ("g2", "KC", 2021, 2, "RES"),
        ("g3", "KC", 2021, 1, "CUT"), ("g1", "BUF", 2023, 1, "ACT"),
    ]
    return spark.createDataFrame(data, "gsis_id string, team string, season int, week int, status string").selectExpr(
        "*", "gsis_id AS full_name", "'QB' AS position", "'QB' AS depth_chart_position",
        "1 AS jersey_number", "2 AS years_exp", "'70' AS height", "200 AS weight",
    )


def stats(spark):
    return spark.createDataFrame(
        [("p1", "DEN", 2019), ("p3", "LA", 2020), ("p1", "KC", 2023)], "player_id string, team string, season int"
    )


def test_lifecycle_prefers_rosters_and_merges_teams(spark):
    out = {r.player_id: r for r in lifecycle.lifecycle(players(spark), rosters(spark), stats(spark)).collect()}
    assert (out["p1"].first_season, out["p1"].last_season) == (2021, 2023)
    assert out["p1"].career_teams == ["BUF", "DEN", "KC"]
    assert out["p1"].status == "active" and out["p1"].primary_position == "QB"
    assert out["p2"].status == "retired" and out["p2"].primary_position == "RB"
    assert out["p3"].status == "inactive"  # last seen 2021, newest season 2023
    assert out["p4"].status == "active" and out["p4"].first_season is None


def test_experience_bands(spark):
    lives = spark.createDataFrame([("a", 2019)], "player_id string, first_season int")
    seasons = spark.createDataFrame([("a", s) for s in (2019, 2020, 2021, 2022, 2022)], "player_id string, season int")
    out = {r.season: r for r in lifecycle.experience(seasons, lives).collect()}
    assert [out[s].category for s in sorted(out)] == ["rookie", "developing", "developing", "veteran"]
    assert [out[s].confidence for s in sorted(out)] == [0.6, 0.8, 0.8, 1.0]
    assert out[2022].strategy == "historical_trend_model"


def test_snapshots_and_changes(spark):
    schedule = spark.createDataFrame(
        [("x", 2021, 1, dt.date(2021, 9, 9), "KC", "BUF")],
        "game_id string, season int, week int, gameday date, home_team string, away_team string",
    )
    depth = spark.createDataFrame(
        [("KC", 2021, 1, "g1", "QB", "Offense", "1", "A", "B")],
        "club_code string, season int, week int, gsis_id string, position string, formation string, "
        "depth_team string, first_name string, last_name string",
    )
    packed = {r.snapshot_id: r for r in lifecycle.snapshots(rosters(spark), schedule, depth).collect()}
    assert set(packed) == {"KC_2021_W1", "KC_2021_W2", "BUF_2023_W1"}
    one, two = packed["KC_2021_W1"], packed["KC_2021_W2"]
    assert [m.gsis_id for m in one.members] == ["g1"]  # CUT is not on the roster
    assert one.new_players == ["g1", "g3"] and one.removed_players == []  # changes cover every status
    assert two.new_players == ["g2"] and two.removed_players == ["g3"]
    assert one.snapshot_date == dt.date(2021, 9, 9) and two.snapshot_date is None
    assert one.depth_chart[0].name == "A B" and two.depth_chart == []
    assert one.position_changes == []
    index = {r.snapshot_id: r for r in lifecycle.snapshot_index(rosters(spark), schedule, depth).collect()}
    for k, r in packed.items():
        assert (index[k].members, index[k].depth_entries) == (len(r.members), len(r.depth_chart))
        assert (index[k].new_players, index[k].removed_players) == (len(r.new_players), len(r.removed_players))


def test_parse_period(spark):
    df = spark.createDataFrame(
        [("2025-08-31T10:00:00Z",), ("2025-09-01T00:00:00Z",), ("2025-09-08T00:00:00Z",), ("2025-12-31T23:00:00Z",),
         ("2026-01-10T00:00:00Z",), ("soon",), (None,)], "dt string")
    out = {r.dt: r.week for r in fx.parse_period(df).collect()}
    assert out["2025-08-31T10:00:00Z"] == 1 and out["2025-09-01T00:00:00Z"] == 1
    assert out["2025-09-08T00:00:00Z"] == 2 and out["2025-12-31T23:00:00Z"] == 18
    assert out["2026-01-10T00:00:00Z"] == 1 and out["soon"] == 1 and out[None] == 1


def test_clock_and_division(spark):
    r = spark.range(1).select(
        fx.clock_minutes(F.lit("3:30")).alias("a"), fx.clock_minutes(F.lit("")).alias("b"),
        fx.clock_minutes(F.lit("x:y")).alias("c"), fx.safe_divide(F.lit(1), F.lit(0)).alias("d"),
        fx.safe_divide(F.lit(1), F.lit(0), 0.5).alias("e"), fx.null_safe_sum(F.lit(None), F.lit(2)).alias("f"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (3.5, None, None, None, 0.5, 2)


def test_merge_lists_ignores_a_null_side(spark):
    df = spark.sql("SELECT array('b','a') x, array('c','a') y UNION ALL SELECT array('b','a'), null")
    assert sorted(tuple(r[0]) for r in df.select(nx.merge_lists("x", "y")).collect()) == [("a", "b"), ("a", "b", "c")]


def test_feed_gate():
    assert not feeds.feed_available("nextgen_passing", 2015, 2010) and feeds.feed_available("nextgen_passing", 2016, 2010)
    assert not feeds.feed_available("pbp", 2021, 2021) and feeds.feed_available("participation", 2024, 2021)
    assert not feeds.feed_available("participation", 2025, 2021)
    assert feeds.feed_available("players", 2021, 2021) and not feeds.feed_available("players", 2022, 2021)


def test_load_feeds_reads_only_wanted_seasons(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([("a", s, 1) for s in (2020, 2021, 2022)], "player_id string, season int, week int")
    df.write.partitionBy("season").parquet(f"{base}/player_stats")
    spark.createDataFrame([("g9",)], "gsis_id string").write.parquet(f"{base}/players")
    depth = [(2024, 3, None), (2025, 0, "2025-09-15T00:00:00Z")]
    spark.createDataFrame(depth, "season int, week int, dt string").write.parquet(f"{base}/depth_charts")
    got = feeds.load_feeds(spark, base, [2021, 2022], ["player_stats", "players", "combine"][:2])
    assert sorted(r.season for r in got["raw_player_stats"].select("season").collect()) == [2021, 2022]
    plan = got["raw_player_stats"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021" in plan
    assert got["raw_players"].select("player_id").first()[0] is None or got["raw_players"].columns.count("player_id") == 1
    weeks = feeds.load_feeds(spark, base, [2024, 2025], ["depth_charts"])["raw_depth_charts"]
    assert sorted((r.season, r.week) for r in weeks.select("season", "week").collect()) == [(2024, 3), (2025, 3)]


def test_align_and_write_modes(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string, c double").schema
    df = spark.createDataFrame([("x", 1, True)], "b string, a long, z boolean")
    assert sinks.align(df, schema).first() == (1, "x", None)
    with pytest.raises(ValueError):
        sinks.align(df.select("z"), schema)
    path = str(tmp_path / "t")
    sinks.write_aligned(df, path, schema, "fail")
    with pytest.raises(ValueError):
        sinks.write_aligned(df, path, schema, "fail")
    sinks.write_aligned(df, path, schema, "append")
    assert spark.read.parquet(path).count() == 2
    sinks.write_aligned(df, path, schema, "replace")
    assert spark.read.parquet(path).count() == 1


def test_refresh_drops_stale_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2020, 1), (2021, 2)], "season int, v int")
    assert sinks.refresh(df, path).count() == 2
    assert sinks.refresh(df.filter("season = 2021"), path).count() == 1
    sinks.write_aligned(df.filter("season = 2020"), path, mode="replace", partition_by=["season"], only_present=True)
    assert spark.read.parquet(path).count() == 2


def test_play_feed_with_another_schema(spark, tmp_path):
    assert schemas.RAW["raw_pbp"]["epa"].dataType.simpleString() == "double"
    spark.createDataFrame([(2023, "g", 1, 0.5)], "season int, game_id string, qtr int, epa double").write.partitionBy(
        "season").parquet(str(tmp_path / "pbp"))
    wanted = schemas.declared("season int, game_id string, qtr int")
    got = feeds.load_feeds(spark, str(tmp_path), [2023], ["pbp"], play_schema=wanted)["raw_pbp"]
    assert got.first().asDict() == {"season": 2023, "game_id": "g", "qtr": 1}


def test_availability_rows(spark):
    seasons = spark.createDataFrame([(2015,), (2015,), (2022,)], "season int")
    got = {(r.season, r.feed): r.available for r in feeds.availability(seasons).collect()}
    assert got[(2015, "players")] and not got[(2022, "players")]
    assert not got[(2015, "pbp")] and got[(2022, "pbp")] and got[(2015, "snap_counts")]
    assert len(got) == 30
