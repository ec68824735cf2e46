"""Rolling windows: closed forms, brute force, hot entities, no look-ahead."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from weekfold.operators import form, windows as win

YARDS = [300, 250, 350, 280, 320, 290, 310, 270, 330, 300]


def game_log(spark, yards=YARDS, player="qb1"):
    return spark.createDataFrame(
        [(player, "A", "QB", 2023, w, "REG", "KC", float(y)) for w, y in enumerate(yards, 1)],
        "player_id string, player_name string, position string, season int, week int, "
        "season_type string, team string, passing_yards double",
    )


def test_means_entering_week_four_and_six(spark):
    out = {r.week: r for r in form.rolling_features(game_log(spark)).collect()}
    assert out[4].passing_yards_avg_3 == 300
    assert out[6].passing_yards_avg_5 == 300
    assert out[4].games_in_window_10 == 3
    assert out[1].passing_yards_avg_3 is None and out[1].games_in_window_3 == 0
    assert out[2].passing_yards_stddev_3 is None  # one point
    assert out[4].passing_yards_min_3 == 250 and out[4].passing_yards_max_3 == 350


def test_linear_series_has_constant_slope(spark):
    out = form.rolling_features(game_log(spark, [250 + 10 * w for w in range(1, 11)])).collect()
    full = [r for r in out if r.games_in_window_3 == 3]
    assert len(full) == 7
    for r in full:
        assert r.passing_yards_trend_3 == pytest.approx(10)
        assert r.passing_yards_stddev_3 == pytest.approx(10)


def test_regular_season_only_and_masking(spark):
    log = game_log(spark).withColumn("season_type", F.when(F.col("week") < 9, "REG").otherwise("POST"))
    log = log.withColumn("fg_made", F.lit(2))  # not a passer's statistic
    out = form.rolling_features(log)
    assert out.count() == 8
    assert out.filter(F.col("fg_made_avg_3").isNotNull()).count() == 0


def test_drop_first_before_hides_game_one(spark):
    out = {r.week: r for r in form.rolling_features(game_log(spark), drop_first_before=True).collect()}
    assert 1 not in out
    assert out[2].games_in_window_3 == 0
    assert out[4].passing_yards_avg_3 == pytest.approx((250 + 350) / 2)


def hot_events(spark, n=600):
    """One user owns two thirds of the events; timestamps repeat."""
    rng = random.Random(3)
    data = [
        (i, 1 if rng.random() < 0.67 else rng.randint(2, 9), rng.randint(0, 40) * 1800, float(rng.randint(0, 99)))
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "event_id long, user_id long, sec long, value double")
    return data, df.withColumn("ts", F.timestamp_seconds("sec"))


def test_blocked_windows_equal_brute_force_for_a_hot_user(spark):
    data, df = hot_events(spark)
    out = win.rolling_events(
        df, ["user_id"], ["ts", "event_id"], ["value"], F.date_trunc("hour", "ts"),
        keep=["event_id", "user_id"], block_rows=16,
    )
    got = {r.event_id: r for r in out.collect()}
    assert len(got) == len(data)
    for user in {d[1] for d in data}:
        mine = sorted((d for d in data if d[1] == user), key=lambda d: (d[2], d[0]))
        for i, d in enumerate(mine):
            r = got[d[0]]
            assert r.event_number == i + 1
            for n in (3, 5, 10):
                past = [x[3] for x in mine[max(0, i - n):i]]
                assert r[f"games_in_window_{n}"] == len(past)
                if past:
                    assert r[f"value_avg_{n}"] == pytest.approx(sum(past) / len(past))
                    assert r[f"value_max_{n}"] == max(past)
                if len(past) > 1:
                    assert r[f"value_stddev_{n}"] == pytest.approx(statistics.stdev(past))


def test_block_must_hold_the_window(spark):
    _, df = hot_events(spark, 5)
    with pytest.raises(ValueError):
        win.rolling_events(df, ["user_id"], ["ts"], ["value"], F.col("ts"), block_rows=4)


def test_features_do_not_depend_on_the_future(spark, rows):
    log = game_log(spark).unionByName(game_log(spark, [10 * w for w in range(1, 11)], "qb2"))
    for cut in (4, 8):
        whole = form.rolling_features(log).filter(F.col("week") <= cut)
        past = form.rolling_features(log.filter(F.col("week") <= cut))
        assert rows(whole) == rows(past)
    # the row's own value must not enter either
    changed = log.withColumn(
        "passing_yards", F.when(F.col("week") == 7, F.lit(9999.0)).otherwise(F.col("passing_yards"))
    )
    now = form.rolling_features(log).filter(F.col("week") <= 7)
    assert rows(now) == rows(form.rolling_features(changed).filter(F.col("week") <= 7))


def test_lookback_takes_last_n_before_the_point(spark):
    at = spark.createDataFrame([("qb1", 2023, 5), ("qb1", 2024, 1), ("nobody", 2023, 3)], "player_id string, season int, week int")
    got = {(r.player_id, r.season, r.week): r for r in win.lookback(game_log(spark), at, ["passing_yards"], 3).collect()}
    assert got[("qb1", 2023, 5)].avg_passing_yards == pytest.approx((250 + 350 + 280) / 3)
    assert got[("qb1", 2024, 1)].avg_passing_yards == pytest.approx(300)
    assert got[("nobody", 2023, 3)].avg_passing_yards == 0 and got[("nobody", 2023, 3)].games_in_window == 0


def test_composite_trends_and_fallbacks(spark):
    log = game_log(spark, [250 + 10 * w for w in range(1, 11)])
    only = form.composite_trends(form.rolling_features(log)).filter("week = 8").first()
    assert only.performance_trend is None  # a passer needs all three statistics
    full = log.withColumns({
        "passing_tds": F.col("week").cast("double"), "rushing_yards": F.lit(5.0), "attempts": F.col("week") * 2.0,
    })
    r = form.composite_trends(form.rolling_features(full, trends_only=True, measures=("avg",))).filter("week = 8").first()
    assert r.performance_trend == pytest.approx(0.6 * 10 + 0.3 * 1 * 20)
    assert r.usage_trend == pytest.approx(2) and r.target_share_trend is None
    back = log.withColumn("position", F.lit("RB")).withColumn("rushing_yards", F.col("passing_yards"))
    r = form.composite_trends(form.rolling_features(back)).filter("week = 8").first()
    assert r.performance_trend == pytest.approx(10)  # rushing slope alone


def test_sparse_documents_leave_nulls_out(spark):
    docs = form.documents(form.rolling_features(game_log(spark)))
    assert docs.columns[4:7] == ["stats_last3_games", "stats_last5_games", "stats_season_avg"]
    first = docs.filter("week = 1").first().stats_last3_games
    assert first == '{"window_size":3.0,"games_in_window":0.0}'
    assert '"passing_yards_avg":300.0' in docs.filter("week = 4").first().stats_last3_games


def test_long_layout_equals_the_wide_one(spark):
    log = game_log(spark).unionByName(
        # a player who changes position keeps the statistics of both
        game_log(spark).withColumns({"player_id": F.lit("p9"), "position": F.when(F.col("week") < 4, "QB").otherwise("K")})
    )
    wide = form.rolling_features(log).collect()
    long = form.rolling_long_features(log)
    got = {(r.player_id, r.season, r.week, r.stat): r for r in long.collect()}
    stats = [c for c in log.columns if f"{c}_avg_3" in wide[0]]
    measures = [f"{m}_{n}" for m in ("avg", "stddev", "trend", "min", "max") for n in (3, 5, 10)]
    seen = 0
    for r in wide:
        for s in stats:
            row = got.get((r.player_id, r.season, r.week, s))
            for m in measures:
                assert (row[m] if row else None) == (pytest.approx(r[f"{s}_{m}"]) if r[f"{s}_{m}"] is not None else None)
                seen += row is not None and row[m] is not None
            assert row is None or row.game_number == r.game_number and row.games_in_window_5 == r.games_in_window_5
    assert seen > 50
    docs = {(r.player_id, r.season, r.week): r for r in form.documents(form.rolling_features(log)).collect()}
    for r in form.long_documents(long).collect():
        for name in ("stats_last3_games", "stats_last5_games", "stats_season_avg"):
            one, other = (json.loads(x[name]) for x in (r, docs[r.player_id, r.season, r.week]))
            assert one == pytest.approx(other)
    # one exchange of players, whatever the number of statistics
    plan = form.rolling_long_features(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_long_layout_needs_no_window_over_long_rows_and_carries_rows_between_batches(spark):
    rng = random.Random(5)
    data = [
        (f"p{p}", "A", "QB" if p % 2 else "K", 2020 + w // 9, w % 9 + 1, "REG", "KC",
         None if rng.random() < 0.3 else rng.randint(-9, 9) / 8, None if rng.random() < 0.3 else rng.choice([0.1, 0.1, 3e5]))
        for p in range(6) for w in range(5 * p)
    ]
    log = spark.createDataFrame(
        data, "player_id string, player_name string, position string, season int, week int, season_type string, team string, "
        "passing_yards double, fantasy_points double",
    )
    measures = [f"{m}_{n}" for m in ("avg", "stddev", "trend", "min", "max") for n in (3, 5, 10)]
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for first in (False, True):
        wide = {(r.player_id, r.season, r.week): r for r in form.rolling_features(log, drop_first_before=first).collect()}
        old = spark.conf.get(batch)
        spark.conf.set(batch, "7")
        try:
            long = form.rolling_long_features(log, drop_first_before=first)
            got = long.collect()
        finally:
            spark.conf.set(batch, old)
        assert len(got) == sum(2 if r.position == "QB" else 1 for r in wide.values())
        for r in got:
            w = wide[r.player_id, r.season, r.week]
            assert all(r[f"games_in_window_{n}"] == w[f"games_in_window_{n}"] for n in (3, 5, 10))
            for m in measures:
                want = w[f"{r.stat}_{m}"]
                assert r[m] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))
    plan = form.rolling_long_features(log)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Sort [") == 1
    for r in form.rolling_long(log, stats=["passing_yards"], places=3).collect():
        assert all(r[m] is None or round(r[m], 3) == r[m] for m in measures)


def test_not_a_number_stays_one_and_broken_order_is_refused():
    import numpy as np
    import pyarrow as pa

    from weekfold.operators import long_windows

    def run(values, numbers):
        b = pa.RecordBatch.from_pydict({
            "game_number": pa.array(numbers, pa.int32()), "_groups": pa.array([0] * len(values), pa.int64()), "s": pa.array(values, pa.float64()),
        })
        bits = np.zeros(1, np.int64)
        return pa.Table.from_batches(long_windows.long_rows([b], ["s"], bits == 0, bits, 1, (3,), win.MEASURES, [])).to_pydict()

    out = run([1.0, float("nan"), None, 7.0], [1, 2, 3, 4])
    # columns: number, stat, value, avg, stddev, trend, min, max, games
    assert out["3"][1] == 1.0 and out["3"][0] is None and np.isnan(out["3"][3])
    assert out["6"][3] == 1.0 and np.isnan(out["7"][3])  # not-a-number is the largest
    assert out["8"] == [0, 1, 2, 3] and out["4"][1] is None
    with pytest.raises(ValueError):
        run([1.0, 2.0], [2, 3])
