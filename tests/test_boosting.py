"""Trees for many models at once, their search and their folds."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import boosting as bo
from weekfold.operators import registry as reg
from weekfold.operators import selection as sel
from weekfold.operators import training as tr

SCHEMA = "feature_id string, model string, season int, split string, features array<double>, label double"


def table(spark, n=400, models=("a", "b")):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in range(4)]
        y = 3 * x[0] + 2 * math.sin(3 * x[1]) + rng.gauss(0, 0.3)
        split = ("train", "train", "validation", "test")[i // len(models) % 4]
        rows.append((f"f{i}", models[i % len(models)], 2000 + i % 7, split, x, y))
    return spark.createDataFrame(rows, SCHEMA)


def rmse(rows, prediction="prediction"):
    return math.sqrt(sum((r["label"] - r[prediction]) ** 2 for r in rows) / len(rows))


def test_both_ways_give_the_same_trees(spark):
    df = table(spark)
    chosen = bo.Settings(depth=3, trees=6, rows=0.8, columns=0.7, gamma=0.01, alpha=0.1, penalty=1.0, least_weight=2)
    near, far = bo.fit(df, chosen), bo.fit(df.repartition(5), chosen, local_rows=0)
    assert set(near.nodes) == {"a", "b"}
    assert all(near.nodes[m].tobytes() == far.nodes[m].tobytes() for m in "ab")


def test_margins_are_written_between_trees(spark, monkeypatch):
    df = table(spark, 120)
    want = bo.fit(df, bo.Settings(depth=2, trees=5))
    monkeypatch.setattr(bo, "KEPT_TREES", 2)
    monkeypatch.setattr(bo, "PASS_NODES", 1)
    got = bo.fit(df, bo.Settings(depth=2, trees=5), local_rows=0)
    assert all(want.nodes[m].tobytes() == got.nodes[m].tobytes() for m in "ab")


def test_one_split_is_the_best_of_all(spark):
    """Brute force over every feature and border for a tree of depth one."""
    df = table(spark, 60, ("a",))
    model = bo.fit(df, bo.Settings(depth=1, trees=1))
    rows = df.collect()
    y = np.array([r.label for r in rows])
    x = np.array([r.features for r in rows])
    bins = model.frames["a"].bins(x)
    best = min(
        sum(((part - part.mean()) ** 2).sum() for part in (y[bins[:, j] <= b], y[bins[:, j] > b]))
        for j in range(4) for b in range(bo.BINS - 1)
        if 0 < (bins[:, j] <= b).sum() < len(y)
    )
    got = model.transform(df).collect()
    assert sum((r.label - r.prediction) ** 2 for r in got) == pytest.approx(best, rel=1e-4)


def test_about_as_good_as_sparks_trees(spark):
    df = table(spark, 800, ("a",))
    ml = df.withColumn("features", array_to_vector("features"))
    train = ml.where("split = 'train'")
    # Spark's squared loss has twice the gradient, so its steps are twice as long
    own = bo.fit(train, bo.Settings(depth=4, trees=15, rate=0.2))
    other = GBTRegressor(maxDepth=4, maxIter=15, stepSize=0.1, seed=1).fit(train)
    later = ml.where("split <> 'train'")
    assert rmse(own.transform(later).collect()) <= 1.05 * rmse(other.transform(later).collect())


def test_classes(spark):
    df = table(spark).withColumn("label", (F.col("label") > 0).cast("double"))
    model = bo.fit(df.where("split = 'train'"), bo.Settings(depth=3, trees=20, task="classification"))
    rows = model.transform(df).collect()
    assert all(0 < r.probability < 1 and (r.probability > 0.5) == (r.prediction == 1) for r in rows)
    assert sum(r.label == r.prediction for r in rows) > 0.85 * len(rows)


def test_save_and_load(spark, tmp_path):
    df = table(spark, 80)
    model = bo.fit(df, bo.Settings(depth=2, trees=3))
    model.save(spark, str(tmp_path))
    again = bo.Models.load(spark, str(tmp_path))
    assert [r.prediction for r in model.transform(df).collect()] == [r.prediction for r in again.transform(df).collect()]
    assert again.specs == model.specs
    assert sum(again.importance("a")) == pytest.approx(1.0)


def test_odd_rows(spark):
    odd = spark.createDataFrame([
        ("n1", "a", 2000, "train", [None, 1.0, float("nan"), 0.0], 1.0), ("n2", "a", 2000, "train", None, 1.0),
        ("n3", None, 2000, "train", [0.0] * 4, 1.0), ("n4", "a", 2000, "train", [0.0] * 4, None),
        ("n5", "tiny", 2000, "train", [0.0] * 4, 5.0),
    ], SCHEMA)
    df = table(spark, 80).unionByName(odd)
    model = bo.fit(df, bo.Settings(depth=2, trees=2), least_rows=2)
    assert set(model.specs) == {"a", "b"}
    got = {r.feature_id: r.prediction for r in model.transform(df.where("features is not null")).collect()}
    assert got["n5"] is None and got["n3"] is None and got["n1"] is not None
    assert bo.fit(df.limit(0), bo.Settings()).specs == {}
    # the same label everywhere: no split, the label itself
    flat = df.where("model = 'b'").withColumn("label", F.lit(2.5))
    assert {round(r.prediction, 6) for r in bo.fit(flat, bo.Settings(trees=2)).transform(flat).collect()} == {2.5}


def test_halving(spark):
    df = table(spark, 240)
    base = bo.Settings()
    found = sel.search(df, base, trials=4, rungs=(0.5, 1.0), depth=(2, 3), trees=(4, 6))
    by_rung = {(m, k): [h for h in found.history if h[0] == m and h[2] == k] for m in "ab" for k in (0, 1)}
    assert [len(by_rung["a", 0]), len(by_rung["a", 1])] == [4, 2]
    drawn = sel.random_settings(base, 4, depth=(2, 3), trees=(4, 6))
    for m in "ab":
        kept = [h for h in by_rung[m, 0] if h[5]]
        assert max(h[4] for h in kept) <= min(h[4] for h in by_rung[m, 0] if not h[5])
        winner = next(h for h in by_rung[m, 1] if h[5])
        assert winner[4] == min(h[4] for h in by_rung[m, 1]) and winner[3] == drawn[winner[1]].trees
        # grown on from the rung below, as in one go
        alone = bo.fit(df.where(f"model = '{m}' and split = 'train'"), drawn[winner[1]])
        judged = found.best.transform(df.where(f"model = '{m}' and split = 'validation'")).collect()
        assert rmse(judged) == pytest.approx(winner[4])
        assert abs(rmse(alone.transform(df.where(f"model = '{m}' and split = 'validation'")).collect()) / winner[4] - 1) < 0.3
    # later rows change nothing; all to the end is an option
    late = df.where("split = 'test'").withColumn("label", F.lit(1e6))
    again = sel.search(df.where("split <> 'test'").unionByName(late), base, trials=4, rungs=(0.5, 1.0), depth=(2, 3), trees=(4, 6))
    assert [h[4] for h in again.history] == [h[4] for h in found.history]
    whole = sel.search(df, base, trials=3, rungs=(1.0,), depth=(2, 2), trees=(2, 3))
    assert len(whole.history) == 6 and sum(h[5] for h in whole.history) == 2
    with pytest.raises(ValueError):
        sel.search(df.drop("split"), base)
    assert sel.search(df, base, trials=2, least_rows=10_000).history == []


def test_folds_equal_each_fold_alone(spark):
    df = sel.season_folds(table(spark, 210), 3)
    seasons = {(r.season, r.fold) for r in df.select("season", "fold").distinct().collect()}
    assert len(seasons) == 7 and {f for _, f in seasons} == {0, 1, 2}
    chosen = bo.Settings(depth=2, trees=3)
    got = {(r.model, r.fold): r for r in sel.fold_scores(df, chosen, 3).where("model is not null").collect()}
    assert len(got) == 6
    rows = bo.frame_rows(df, "model", part=F.col("fold"))
    frames = bo.frames_of(rows)
    stored = bo.binned(rows, frames)
    for (m, k), r in got.items():
        spec = bo.specified(frames, "x", m, chosen, [p for p in range(3) if p != k])
        # without the fold's rows in the table at all
        nodes = bo.grow(stored.where(f"part <> {k}"), [spec], frames)
        scored = bo.Models({"x": spec}, frames, nodes).scores(stored.where(f"part = {k} and frame = '{m}'"), ["label"], "label double")
        assert rmse(scored.collect(), "margin") == pytest.approx(r.score)
        assert r.n + r.fitted == df.where(f"model = '{m}'").count()
    mean = {r.model: r for r in sel.cross_validated(sel.fold_scores(df, chosen, 3, "neg_mean_squared_error")).collect()}
    own = [-got["a", k].score ** 2 for k in range(3)]
    assert mean["a"].mean_score == pytest.approx(np.mean(own)) and mean["a"].std_score == pytest.approx(np.std(own))


def test_all_models_to_the_model_table(spark, tmp_path):
    rng = random.Random(3)
    data = [(f"f{i}", "RB", 2023, i, ["train", "validation"][i % 4 == 0], [rng.random() for _ in range(47)],
             {"rushing_yards": float(i), "receptions": 1.0}) for i in range(40)]
    df = spark.createDataFrame(
        data, "feature_id string, position string, season int, week int, split string, numerical array<double>, outcomes map<string,double>"
    )
    summary = tr.train_all(df, [("RB", "rushing_yards"), ("RB", "receptions"), ("QB", "attempts")], str(tmp_path), maxIter=2)
    rows = {(r.position, r.target, r.split): r for r in summary.collect()}
    assert rows["QB", "attempts", None].status == "skipped" and rows["RB", "receptions", "validation"].n == 10
    models = bo.Models.load(spark, str(tmp_path))
    assert set(models.specs) == {"RB/rushing_yards", "RB/receptions"}
    new = tr.model_rows(summary, F.lit("2024-01-01 00:00:00").cast("timestamp"), str(tmp_path))
    old = spark.createDataFrame([
        ("m1", "RB_receptions", "1.2.3", "regression", "active", "{}", None, None, None),
    ], "model_id string, model_name string, version string, model_type string, status string, metrics string, "
       "primary_metric double, created_at timestamp, tags string")
    twice = new.unionByName(new.withColumn("model_id", F.concat("model_id", F.lit("x"))))
    added = reg.append_versions(old, twice)
    assert added.columns == old.columns
    got = {}
    for r in added.orderBy("model_id").collect():
        got.setdefault(r.model_name, []).append(r.version)
        assert r.primary_metric is not None
    assert got == {"RB_receptions": ["1.2.4", "1.2.5"], "RB_rushing_yards": ["1.0.0", "1.0.1"]}
    assert config.TREE_PENALTIES["columns"] < 1
