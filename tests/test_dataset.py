"""Vectors, quality, targets, splits and the whole run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weekfold import config, schemas
from weekfold.operators import form, quality, targets, temporal
from weekfold.plans import build, dataset
from weekfold.sources import sinks


def vectors(spark, data):
    return spark.createDataFrame(
        data, "feature_id string, season int, week int, position string, team string, opponent_team string, numerical array<double>"
    )


@pytest.mark.parametrize("nonzero,score", [(47, 1.0), (36, 0.8), (24, 0.6), (12, 0.3), (11, 0.0)])
def test_completeness_steps(spark, nonzero, score):
    row = ("a", 2023, 5, "QB", "A", "B", [1.0] * nonzero + [0.0] * (47 - nonzero))
    assert quality.score_quality(vectors(spark, [row])).first().completeness_score == score


@pytest.mark.parametrize("extreme,score", [(0, 1.0), (2, 0.9), (5, 0.7), (10, 0.5), (11, 0.0)])
def test_outlier_steps(spark, extreme, score):
    row = ("a", 2023, 5, "QB", "A", "B", [-1001.0] * extreme + [1000.0] * (47 - extreme))
    got = quality.score_quality(vectors(spark, [row])).first()
    assert got.outlier_score == score and ("high_outliers" in got.flags) == (extreme > 5)


def test_recency_gate_flags_and_filter(spark):
    full = [1.0] * 47
    df = vectors(spark, [
        ("new", 2023, 10, "QB", "A", "B", full), ("old", 2021, 1, "QB", "A", "B", full),
        ("gap", 2023, 10, None, "A", None, full),
    ])
    out = {r.feature_id: r for r in quality.score_quality(df).collect()}
    assert out["new"].recency_score == 1.0 and out["new"].quality == pytest.approx(1.0) and out["new"].flags == []
    assert out["old"].weeks_ago == 45 and out["old"].recency_score == 0.5 and out["old"].flags == ["stale_data"]
    assert out["gap"].quality == 0 and out["gap"].flags == ["missing_position", "missing_opponent"]
    scored = quality.score_quality(df)
    s = quality.quality_summary(scored).first()
    assert s.scored == s.passed + s.filtered == 3 and s.filtered == 1
    unknown = scored.withColumn("quality", F.lit(None).cast("double"))
    assert quality.passing(unknown).count() == 3  # an unknown score is kept


def test_targets_per_position(spark):
    features = spark.createDataFrame(
        [("f1", "q", 2023, 2, "QB"), ("f2", "k", 2023, 2, "K"), ("f3", "w", 2023, 2, "WR"), ("f4", "none", 2023, 2, "RB")],
        "feature_id string, entity_id string, season int, week int, position string",
    )
    stats = spark.createDataFrame(
        [("q", 2023, 2, "A", 200, 10, 20, 0, 0, 0, 0, 0, 9.0), ("k", 2023, 2, "B", 0, 0, 0, 3, 2, 0, 0, 0, 1.0),
         ("w", 2023, 2, "Z", 0, 0, 0, 0, 0, 80, 4, 0, 7.0)],
        "player_id string, season int, week int, team string, passing_yards int, completions int, attempts int, fg_made int, "
        "pat_made int, receiving_yards int, receptions int, targets int, fantasy_points_ppr double",
    )
    schedule = spark.createDataFrame(
        [("g", 2023, "REG", 2, "A", "B", 21, 21)],
        "game_id string, season int, game_type string, week int, home_team string, away_team string, home_score int, away_score int",
    )
    found = targets.targets(features, stats, schedule)
    out = {r.feature_id: r for r in found.collect()}
    q = out["f1"].outcomes
    assert q["completion_pct"] == 0.5 and q["team_points"] == 21 and q["team_won"] == 0.5 and q["fantasy_points_ppr"] == 9
    assert out["f2"].outcomes["fantasy_points_standard"] == 11 and out["f2"].prediction_target == "fg_made"
    assert out["f3"].outcomes["yards_per_reception"] == 20 and out["f3"].outcomes["catch_rate"] == 0
    assert out["f3"].outcomes["team_points"] is None  # its team had no game
    assert out["f4"].outcomes["rushing_yards"] == 0 and out["f4"].prediction_target == "rushing_yards"
    flagged = targets.with_targets(features, found.filter("feature_id <> 'f4'"))
    assert {r.feature_id: r.flags for r in flagged.collect()}["f4"] == ["no_target_data"]


def labelled(spark, n=100, periods=10):
    rng = random.Random(1)
    data = [(f"f{i}", 2020 + p // 5, p % 5 + 2, ["a"], {"x": 1.0}) for i in range(n) for p in [rng.randrange(periods)]]
    return data, spark.createDataFrame(data, "feature_id string, season int, week int, names array<string>, outcomes map<string,double>")


def test_ratio_split_counts_and_order(spark):
    _, df = labelled(spark)
    out = temporal.ratio_split(df).collect()
    by = {s: [r.season * 100 + r.week for r in out if r.split == s] for s in temporal.SPLITS}
    assert {s: len(v) for s, v in by.items()} == {"train": 70, "validation": 20, "test": 10}
    assert max(by["train"]) <= min(by["validation"]) and max(by["validation"]) <= min(by["test"])
    assert len({r.feature_id for r in out}) == 100
    with pytest.raises(ValueError):
        temporal.ratio_split(df, (0.7, 0.2, 0.2))


def test_ratio_split_inside_one_hot_period(spark):
    data = [(f"f{i}", 2023, 5) for i in range(50)]
    df = spark.createDataFrame(data, "feature_id string, season int, week int")
    got = {r.split: r["count"] for r in temporal.ratio_split(df).groupBy("split").count().collect()}
    assert got == {"train": 35, "validation": 10, "test": 5}


def test_ratio_split_cuts_at_the_exact_share(spark):
    n = next(n for n in range(10, 1000, 10) if int(n * 0.7) < n * 7 // 10)  # the double lies below the whole number
    df = spark.range(n).select(F.col("id").cast("string").alias("feature_id"), F.lit(2023).alias("season"), F.lit(5).alias("week"))
    got = {r.split: r["count"] for r in temporal.ratio_split(df).groupBy("split").count().collect()}
    assert got == {"train": n * 7 // 10, "validation": n // 5, "test": n // 10}


def test_temporal_split_by_distinct_period(spark):
    _, df = labelled(spark)
    spans = {r.split: r for r in temporal.split_ranges(temporal.temporal_split(df)).collect()}
    assert spans["train"].latest < spans["validation"].earliest < spans["test"].earliest
    periods = temporal.temporal_split(df).select("season", "week", "split").distinct().groupBy("split").count()
    assert {r.split: r["count"] for r in periods.collect()} == {"train": 7, "validation": 2, "test": 1}


def test_leak_checks_pass_and_fail(spark):
    _, df = labelled(spark)
    split = temporal.temporal_split(df)
    assert [r.passed for r in temporal.require_clean(temporal.leak_checks(split)).collect()] == [True] * 4
    bad = split.withColumn("week", F.lit(1)).withColumn("names", F.array(F.lit("team_win_rate"), F.lit("ok")))
    bad = bad.withColumn("outcomes", F.lit(None).cast("map<string,double>"))
    log = {r.check_name: r for r in temporal.leak_checks(bad).collect()}
    assert log["week_1_features"].violations == 100
    assert log["future_outcome_leakage"].violations == 1 and "team_win_rate" in log["future_outcome_leakage"].details
    assert log["split_temporal_order"].violations >= 1
    assert log["data_completeness"].violations == 2
    with pytest.raises(ValueError, match="week_1_features"):
        temporal.require_clean(temporal.leak_checks(bad))


# --- the whole run -----------------------------------------------------------------
def tables(spark, weeks=9, seasons=(2022, 2023)):
    """Five players of five positions over two seasons, linear in the week."""
    rng = random.Random(7)
    stats, games, plays, rosters = [], [], [], []
    roster = [("p1", "QB", "A"), ("p2", "RB", "A"), ("p3", "WR", "B"), ("p4", "TE", "B"), ("p5", "K", "A")]
    for s in seasons:
        for w in range(1, weeks + 1):
            games.append((f"{s}_{w}", s, "REG", w, dt.date(s, 9, w), "A", "B", 20 + w, 17, 7, 7, 1))
            for pid, pos, t in roster:
                base = 10.0 * w + rng.randint(0, 3)
                stats.append((pid, pid, pos, s, w, "REG", t, "B" if t == "A" else "A", base, base + 2, int(base), w, int(base), w % 3, 2, 1, w))
                rosters.append((pid, t, s, w, "ACT"))
            for t, o in (("A", "B"), ("B", "A")):
                for k in range(4):
                    plays.append((f"{s}_{w}", s, w, "REG", t, o, k, 5, "2:00", "pass" if k % 2 else "run", 1, k % 3 + 1, k * 4, 20 * k, 0.1 * k - 0.1, k % 2, int(k == 1), k % 2, 1 - k % 2, 0, 0, 0, 0, 0, 0, 0, 500))
    stat_df = spark.createDataFrame(stats, "player_id string, player_name string, position string, season int, week int, season_type string, team string, opponent_team string, fantasy_points double, fantasy_points_ppr double, passing_yards int, passing_tds int, rushing_yards int, carries int, fg_made int, pat_made int, targets int")
    from tests.test_features import SCHEMA

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    raw = spark.createDataFrame(plays, "game_id string, season int, week int, season_type string, posteam string, defteam string, drive int, drive_play_count int, drive_time_of_possession string, play_type string, play int, down int, yards_gained int, yardline_100 int, epa double, success int, touchdown int, pass_attempt int, rush_attempt int, qb_hit int, sack int, interception int, fumble_lost int, third_down_converted int, third_down_failed int, score_differential int, quarter_seconds_remaining int")
    assert set(raw.columns) == set(names)
    roster_df = spark.createDataFrame(rosters, "gsis_id string, team string, season int, week int, status string").selectExpr(
        "*", "gsis_id AS full_name", "'QB' AS position", "'QB' AS depth_chart_position", "1 AS jersey_number",
        "2 AS years_exp", "'70' AS height", "200 AS weight")
    return {
        "stats": stat_df, "plays": raw, "rosters": roster_df,
        "players": spark.createDataFrame([(p, p, q) for p, q, _ in roster], "player_id string, gsis_id string, position string").selectExpr(
            "*", "position AS position_group", "gsis_id AS espn_id", "2020 AS draft_year", "1 AS draft_round", "1 AS draft_pick", "'X' AS college", "'ACT' AS status"),
        "schedule": spark.createDataFrame(games, "game_id string, season int, game_type string, week int, gameday date, home_team string, away_team string, home_score int, away_score int, home_rest int, away_rest int, div_game int"),
        "depth": roster_df.selectExpr("team AS club_code", "season", "week", "gsis_id", "position", "'Offense' AS formation", "'1' AS depth_team", "gsis_id AS first_name", "'x' AS last_name"),
        "team_stats": stat_df.select("team", "season", "week").distinct(),
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    t = tables(spark)
    out = str(tmp_path_factory.mktemp("run"))
    return t, out, build.build(t, out)


def test_whole_run_gives_full_vectors(spark, run):
    t, out, stages = run
    rows = stages["ml_features"].collect()
    assert rows and all(len(r.numerical) == 47 == len(r.names) for r in rows)
    assert min(r.week for r in rows) > 1
    assert {r.position for r in rows} <= set(config.VECTOR_POSITIONS)
    assert spark.read.parquet(f"{out}/validation_log").filter("passed").count() == 4
    one = next(r for r in rows if r.entity_id == "p1" and r.season == 2023 and r.week == 6)
    slots = dict(zip(one.names, one.numerical))
    past = {r.week: r for r in t["stats"].filter("player_id = 'p1' AND season = 2023").collect()}
    # the vector of week 6 carries the features of week 5: games before week 5
    assert slots["last3_passing_yards"] == pytest.approx(sum(past[w].passing_yards for w in (2, 3, 4)) / 3)
    assert slots["rest_days"] == 7 and slots["opp_rank_vs_position"] > 0
    assert one.categorical.home_away.value == "home" and one.categorical.position.encoded == 1
    assert one.outcomes["passing_yards"] == past[6].passing_yards


def test_vector_width_and_names():
    for p in config.VECTOR_POSITIONS:
        assert len(config.vector_names(p)) == 47
    assert [len(config.position_stats(p)) for p in ("QB", "WR", "RB", "TE", "K", "DEF")] == [30, 34, 32, 32, 37, 28]


def test_alignment_option(spark, run):
    t, _, stages = run
    shifted = stages["player_rolling"].withColumn("rest_days", F.col("week"))
    args = (t["stats"], t["schedule"], shifted, stages["team_rolling"], stages["experience"])
    slot = config.VECTOR_UNIVERSAL.index("rest_days")
    lagged = dataset.assemble(*args).select("week", F.col("numerical")[slot].alias("r")).collect()
    target = dataset.assemble(*args, "target").select("week", F.col("numerical")[slot].alias("r")).collect()
    assert all(r.r == r.week - 1 for r in lagged) and all(r.r == r.week for r in target)
    with pytest.raises(ValueError):
        dataset.assemble(*args, "other")


def test_dataset_does_not_depend_on_the_future(spark, run, tmp_path):
    t, _, stages = run
    cut = "season * 100 + week <= 202306"
    early = {k: v if k == "players" else v.filter(cut) for k, v in t.items()}
    again = build.entity_stages(early, str(tmp_path)) | build.feature_stages(early, str(tmp_path))
    vecs = dataset.assemble(early["stats"], early["schedule"], again["player_rolling"], again["team_rolling"], again["experience"])
    whole = dataset.assemble(t["stats"], t["schedule"], stages["player_rolling"], stages["team_rolling"], stages["experience"]).filter(cut)
    pick = lambda df: {r.feature_id: [round(x, 6) for x in r.numerical] for r in df.collect()}
    assert pick(vecs) == pick(whole)


def test_missing_inputs_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="rosters"):
        build.build({**tables(spark, 2, (2023,)), "rosters": None}, str(tmp_path))


@pytest.mark.parametrize("season", [2021, 2022])
def test_from_feed_files_to_the_dataset(spark, tmp_path, season):
    """Plays exist from 2022 on; a second run over the same files loads nothing."""
    made = tables(spark, 7, (season - 1, season))
    for key, table in build.RAW_INPUTS.items():
        if key == "plays" and season < 2022:
            continue
        feed = sinks.align(made[key], schemas.RAW[table])
        writer = feed.write.partitionBy("season") if "season" in feed.columns else feed.write
        writer.parquet(str(tmp_path / "feeds" / table.removeprefix("raw_")))
    folders = [str(tmp_path / n) for n in ("feeds", "raw", "out")]
    stages, counts = build.build_from_feeds(spark, folders[0], [season - 1, season], *folders[1:])
    assert stages["ml_features"].count() > 0
    assert stages["snapshot_depth"].count() == made["depth"].count()
    first = {r.table_name: r for r in counts.collect()}
    assert ("raw_pbp" in first) == (season >= 2022)
    assert first["raw_player_stats"].new_rows == made["stats"].count()
    form = stages["team_rolling"].filter("week > 3").collect()
    assert form and (season < 2022) == all(r.pace_of_play == 65.0 for r in form)
    _, again = build.build_from_feeds(spark, folders[0], [season - 1, season], *folders[1:])
    assert all(r.new_rows == 0 for r in again.collect())


def test_documents_pass_the_structure_check(spark, run):
    t, *_ = run
    docs = form.documents(form.rolling_features(t["stats"]))
    out = quality.check_feature_json(docs, "stats_last3_games").collect()
    assert all(r.missing_keys == 0 for r in out) and sum(r.total for r in out) == docs.count()


def test_export_as_json(spark, run, tmp_path):
    _, _, stages = run
    build.export_json(stages["ml_features"], str(tmp_path / "x"))
    got = dict(spark.read.parquet(str(tmp_path / "x")).dtypes)
    assert got["categorical"] == got["outcomes"] == "string" and got["numerical"] == "array<double>"
