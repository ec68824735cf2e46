"""Team form and matchup context against closed forms and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import joins as jn
from weekfold.operators import form, matchup, team
from weekfold.plans.player import player_features

PLAY = {
    "game_id": "g1", "season": 2023, "week": 1, "season_type": "REG", "posteam": "KC", "defteam": "BUF",
    "drive": 1, "drive_play_count": 4, "drive_time_of_possession": "2:30", "play_type": "pass", "play": 1,
    "down": 1, "yards_gained": 5, "yardline_100": 50, "epa": 0.5, "success": 1, "touchdown": 0,
    "pass_attempt": 1, "rush_attempt": 0, "qb_hit": 0, "sack": 0, "interception": 0, "fumble_lost": 0,
    "third_down_converted": 0, "third_down_failed": 0, "score_differential": 0, "quarter_seconds_remaining": 600,
}
SCHEMA = ", ".join(
    f"{k} {'double' if k == 'epa' else 'string' if isinstance(v, str) else 'int'}" for k, v in PLAY.items()
)


def plays(spark, *changes):
    return spark.createDataFrame([tuple({**PLAY, **c}.values()) for c in changes], SCHEMA)


def entering(df, name="KC", week=4):
    return df.filter((F.col("team") == name) & (F.col("week") == week)).first()


def test_red_zone_one_scoring_drive(spark):
    df = plays(spark, {"yardline_100": 15}, {"yardline_100": 4, "touchdown": 1}, {"week": 2, "drive": 9})
    assert entering(team.red_zone(df)).off_red_zone_efficiency == 1.0
    never = plays(spark, {"yardline_100": 60})
    assert entering(team.red_zone(never)).off_red_zone_efficiency == 0.5


def test_drive_numbers_of_different_games(spark):
    df = plays(
        spark, {"yardline_100": 10, "touchdown": 1},
        {"yardline_100": 10, "week": 2, "game_id": "g2"},  # same drive number, other game
    )
    assert entering(team.red_zone(df)).off_red_zone_efficiency == 0.5  # 1 of 2 drives
    assert entering(team.red_zone(df, drive_key=("drive",))).off_red_zone_efficiency == 1.0  # merged
    # only the second game is left in week 5's window
    assert entering(team.red_zone(df), week=5).off_red_zone_efficiency == 0.0


def test_offence_rates(spark):
    df = plays(
        spark,
        {"epa": 1.0, "yards_gained": 20}, {"epa": -1.0, "success": 0},
        {"epa": None}, {"play": 0, "epa": 9.0}, {"play_type": "punt", "epa": 9.0},
        {"down": 3, "third_down_converted": 1, "epa": 0.0}, {"down": 3, "third_down_failed": 1, "epa": 0.0, "success": 0},
    )
    r = entering(team.offence(df))
    assert r.off_epa_per_play_last3 == 0 and r.off_success_rate_last3 == 0.5
    assert r.off_explosive_play_rate == 0.25 and r.off_third_down_conv == 0.5


def test_defence_rates(spark):
    df = plays(
        spark, {"qb_hit": 1, "sack": 1, "success": 0}, {"interception": 1, "drive": 2}, {"drive": 2, "pass_attempt": 0},
    )
    r = entering(team.defence(df), "BUF")
    assert r.def_epa_per_play_last3 == 0.5
    assert r.def_success_rate_last3 == pytest.approx(1 / 3)
    assert r.def_pressure_rate == 1.0 and r.def_turnover_rate == 0.5


def test_neutral_rate_and_pace(spark):
    df = plays(
        spark, {}, {"pass_attempt": 0, "rush_attempt": 1}, {"score_differential": 8}, {"quarter_seconds_remaining": 120},
        {"down": 3}, {"drive": 2, "drive_play_count": 8, "drive_time_of_possession": ""},
        {"drive": 3, "drive_play_count": None},
    )
    # the two later plays are neutral passes as well: 3 passes, 1 run
    assert entering(team.neutral_pass_rate(df)).pass_rate_neutral == pytest.approx(3 / 4)
    r = entering(team.pace(df))
    assert r.pace_of_play == 6.0 and r.time_of_possession_avg == 2.5


def team_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "team string, season int, week int")


def test_team_aggregates_chooses_a_path_per_season(spark):
    df = plays(
        spark, {"week": 1}, {"week": 4}, {"season": 2021, "week": 4}, {"week": 5, "season_type": "POST"},
    )
    fallback = team_rows(spark, ("KC", 2021, 4), ("KC", 2021, 3), ("KC", 2023, 4), ("NYJ", 2023, 9))
    out = {(r.team, r.season, r.week): r for r in team.team_aggregates(df, fallback).collect()}
    # 2023 comes from plays: KC attacked, BUF only defended in the fixture
    assert set(out) == {("KC", 2023, 4), ("KC", 2021, 4)}
    assert out[("KC", 2023, 4)].off_epa_per_play_last3 == 0.5
    assert out[("KC", 2023, 4)].def_success_rate_last3 == 0.5  # default
    for name, value in config.TEAM_METRICS.items():
        assert out[("KC", 2021, 4)][name] == value


def test_season_with_only_early_plays_has_no_rows(spark):
    out = team.team_aggregates(plays(spark, {"week": 2}), team_rows(spark, ("KC", 2023, 6)))
    assert out.count() == 0


# --- matchup -----------------------------------------------------------------------
def league(spark, seed=5, weeks=8, seasons=(2022, 2023)):
    """Four teams, two players each, one player changing team; random results."""
    rng = random.Random(seed)
    teams = ["A", "B", "C", "D"]
    stats, games = [], []
    for s in seasons:
        for w in range(1, weeks + 1):
            order = teams[:]
            rng.shuffle(order)
            pairs = [(order[0], order[1]), (order[2], order[3])]
            for h, a in pairs:
                games.append((f"{s}{w}{h}", s, "REG", w, h, a, rng.randint(0, 40), rng.randint(0, 40), 4 if w == 3 else None, None, int(h < a)))
            for t in teams:
                rival = next(a if h == t else h for h, a in pairs if t in (h, a))
                for k, pos in enumerate(("QB", "RB")):
                    if rng.random() < 0.85:
                        pid = f"{t}{k}" if not (t == "A" and s == 2023 and k == 1) else "B1x"
                        stats.append((pid, pos, s, w, "REG", t, rival, float(rng.randint(0, 30)), rng.randint(0, 300), rng.randint(0, 90), rng.randint(0, 3)))
    return (
        spark.createDataFrame(stats, "player_id string, position string, season int, week int, season_type string, team string, "
                              "opponent_team string, fantasy_points double, passing_yards int, rushing_yards int, rushing_tds int"),
        spark.createDataFrame(games, "game_id string, season int, game_type string, week int, home_team string, away_team string, "
                              "home_score int, away_score int, home_rest int, away_rest int, div_game int"),
        stats, games,
    )


def test_context_against_brute_force(spark):
    stats, schedule, srows, grows = league(spark)
    team_stats = stats.select("team", "season", "week").distinct()
    got = {(r.player_id, r.season, r.week): r for r in matchup.context(stats, schedule, team_stats).collect()}
    assert len(got) == len(srows)
    home = {(g[4], g[1], g[3]) for g in grows}
    teams = {(r[5], r[2], r[3]) for r in srows}
    for r in srows:
        pid, pos, s, w, _, t, opp = r[:7]
        row = got[(pid, s, w)]
        past = [x for x in srows if x[0] == pid and (x[2], x[3]) < (s, w)]
        at_home = [x for x in past if (x[5], x[2], x[3]) in home]
        assert row.home_games == len(at_home) and row.away_games == len(past) - len(at_home)
        if at_home:
            assert row.home_avg_yards == pytest.approx(sum(x[8] + x[9] for x in at_home) / len(at_home))
        met = sorted((x for x in past if x[6] == opp), key=lambda x: (x[2], x[3]), reverse=True)[:3]
        assert [(h.season, h.week, h.touchdowns) for h in row.opp_history or []] == [(x[2], x[3], x[10]) for x in met]
        assert (row.opp_history is None) == (not met)
        metric = {"QB": 8, "RB": 9}[pos]
        allowed = {}
        for d in {x[0] for x in teams if x[1:] == (s, w)}:
            vals = [x[metric] for x in srows if x[6] == d and (x[2], x[3]) == (s, w) and x[1] == pos]
            allowed[d] = sum(vals) / len(vals) if vals else 0.0
        if opp in allowed:
            assert row.opp_rank_vs_position == 1 + sum(v < allowed[opp] for v in allowed.values())
        else:
            assert row.opp_rank_vs_position == 16
        seen = [x for x in srows if x[6] == opp and x[1] == pos and (x[2], x[3]) < (s, w) and x[2] >= s - 1]
        name = {"QB": "passing_yards", "RB": "rushing_yards"}[pos]
        want = sum(x[metric] for x in seen) / len(seen) if seen else 0.0
        assert row.opp_allowed[name] == pytest.approx(want)
        assert row.rest_days == (4 if w == 3 and (t, s, w) in home else 7)


def test_rows_without_a_game_stay_null(spark):
    stats, schedule, *_ = league(spark, weeks=2, seasons=(2023,))
    out = matchup.with_game(stats, schedule.filter("week = 1")).filter("week = 2")
    assert out.filter("rest_days IS NOT NULL OR divisional_game IS NOT NULL").count() == 0
    assert matchup.with_game(stats, schedule).filter("week = 2 AND rest_days <> 7").count() == 0


def test_context_ignores_the_future(spark, rows):
    stats, schedule, *_ = league(spark)
    team_stats = stats.select("team", "season", "week").distinct()
    cut = "season * 100 + week <= 202304"
    whole = matchup.context(stats, schedule, team_stats).filter(cut)
    past = matchup.context(stats.filter(cut), schedule.filter(cut), team_stats.filter(cut))
    assert rows(whole.drop("opp_allowed")) == rows(past.drop("opp_allowed"))


def test_one_flow_equals_the_join(spark):
    stats, schedule, *_ = league(spark)
    stats = stats.withColumn("season_type", F.when(F.col("week") < 7, "REG").otherwise("POST"))
    team_stats = stats.select("team", "season", "week").distinct()
    joined = matchup.matchup(form.composite_trends(form.rolling_features(stats)), stats, schedule, team_stats)
    flow = player_features(stats, schedule, team_stats)
    assert set(flow.columns) == set(joined.columns)

    def values(df):
        order = sorted(df.columns)
        return {
            (r.player_id, r.season, r.week): [round(r[c], 6) if isinstance(r[c], float) else r[c] for c in order if c != "opp_allowed"]
            for r in df.collect()
        }

    assert values(flow) == values(joined)
    plan = flow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") < joined._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_update_delete_and_lag(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (2, None), (3, "q")], "k int, v string")
    assert rows(jn.update_from(base, new, ["k"], ["v"]), "k", "v") == [(1, "z"), (2, "b")]
    scores = spark.createDataFrame([(1, 0.2), (2, None), (3, 0.9)], "k int, s double")
    assert rows(jn.delete_where(scores, F.col("s") < 0.5), "k") == [(2,), (3,)]
    weeks = spark.createDataFrame([(17,), (18,)], "week int")
    assert rows(jn.lag_period(weeks)) == [(18,)]


def test_schedule_long_form_has_no_or_join(spark):
    stats, schedule, *_ = league(spark, weeks=2, seasons=(2023,))
    plan = jn.attach_game(stats, schedule, ["game_role"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
