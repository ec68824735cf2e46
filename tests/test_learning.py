"""Models, metrics and the model table."""

import math
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import registry as reg
from weekfold.operators import training as tr


def frame(spark, n=80):
    rng = random.Random(2)
    data = []
    for i in range(n):
        x = [rng.random() for _ in range(3)]
        data.append((f"f{i}", "RB", 2023, 2, ["train", "validation"][i % 4 == 0], x, {"rushing_yards": 10 * x[0] + x[1]}))
    return spark.createDataFrame(
        data, "feature_id string, position string, season int, week int, split string, numerical array<double>, outcomes map<string,double>"
    )


SMALL = {"maxIter": 5, "maxDepth": 3}


def test_missing_target_counts_as_zero(spark):
    df = tr.to_ml_frame(frame(spark), "no_such_target")
    assert df.agg(F.max("label")).first()[0] == 0.0


def test_too_few_rows_are_skipped(spark):
    ml = tr.to_ml_frame(frame(spark, 9), "rushing_yards")
    assert tr.fit(ml) is None
    out = tr.train_all(frame(spark, 9), [("RB", "rushing_yards")]).first()
    assert out.status == "skipped"


def test_fit_score_importance_save_load(spark, tmp_path):
    ml = tr.to_ml_frame(frame(spark), "rushing_yards")
    model = tr.fit(ml.withColumn("is_validation", F.col("split") == "validation"), **SMALL)
    best = tr.importance(model, ["a", "b", "c"]).first()
    assert best.feature == "a" and best.importance > 0.5
    tr.save(model, str(tmp_path / "m"), ["a", "b", "c"])
    again, names = tr.load(spark, str(tmp_path / "m"))
    assert names == ["a", "b", "c"]
    assert [r.prediction for r in tr.score(again, ml).orderBy("feature_id").collect()] == [
        r.prediction for r in tr.score(model, ml).orderBy("feature_id").collect()]
    out = {r.split: r for r in tr.train_all(frame(spark), [("RB", "rushing_yards")], **SMALL).collect()}
    assert out["train"].r2 > 0.8 and out["train"].status == "trained" and set(out) == {"train", "validation"}


def test_regression_metrics(spark):
    y, p = [1.0, 2.0, 4.0], [1.5, 2.0, 3.0]
    r = tr.regression_metrics(spark.createDataFrame(list(zip(y, p)), "label double, prediction double")).first()
    e = [a - b for a, b in zip(y, p)]
    mean = sum(y) / 3
    assert r.rmse == pytest.approx(math.sqrt(sum(x * x for x in e) / 3))
    assert r.mae == pytest.approx(0.5)
    assert r.r2 == pytest.approx(1 - sum(x * x for x in e) / sum((v - mean) ** 2 for v in y))


def test_classification_metrics_and_auc(spark):
    data = [(1, 1, .9), (1, 0, .4), (0, 0, .4), (0, 1, .8), (0, 0, .1), (1, 1, .8)]
    df = spark.createDataFrame(data, "label int, prediction int, score double")
    r = tr.classification_metrics(df).first()
    assert r.accuracy == pytest.approx(4 / 6) and r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)
    assert r.weighted_f1 == pytest.approx(2 / 3)
    pairs = [(a[2], b[2]) for a in data if a[0] for b in data if not b[0]]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert tr.area_under_roc(df).first().auc == pytest.approx(want)


def test_never_predicted_class_scores_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = tr.classification_metrics(df).first()
    assert r.precision == 0 and r.recall == 0 and r.accuracy == 0.5


def test_search_and_folds(spark):
    ml = tr.to_ml_frame(frame(spark), "rushing_yards")
    found = tr.tune(ml, trials=2, depth=(2, 3), trees=(2, 3))
    assert len(found.validationMetrics) == 2
    # rows after the validation part change nothing
    later = ml.withColumns({"split": F.lit("test"), "label": F.lit(1e6)})
    assert tr.tune(ml.union(later), trials=2, depth=(2, 3), trees=(2, 3)).validationMetrics == found.validationMetrics
    with pytest.raises(ValueError):
        tr.tune(ml.drop("split"), trials=1)
    one, two = (tr.random_grid(tr.estimator(), 3) for _ in range(2))
    assert [sorted(p.values()) for p in one] == [sorted(p.values()) for p in two]
    folded = ml.withColumn("fold", (F.hash("feature_id") % 2 == 0).cast("int"))
    r = tr.cross_validate(folded, folds=2, fold_col="fold", metric="mse", maxIter=2, maxDepth=2).first()
    assert r.mean_score > 0 and r.folds == 2


def test_all_models_are_kept_and_bad_input_refused(spark, tmp_path):
    path = str(tmp_path)
    tr.train_all(frame(spark), [("RB", "rushing_yards")], models_path=path, **SMALL)
    names = [r.name for r in spark.read.parquet(f"{path}/RB/rushing_yards/features").orderBy("slot").collect()]
    assert names == config.vector_names("RB")
    with pytest.raises(ValueError, match="XX"):
        tr.train_all(frame(spark), [("XX", "rushing_yards")])
    with pytest.raises(ValueError, match="empty"):
        tr.train_all(frame(spark).limit(0))


def test_classification_fit(spark):
    df = frame(spark).select(array_to_vector("numerical").alias("features"), (F.col("numerical")[0] > 0.5).cast("double").alias("label"))
    scored = tr.score(tr.fit(df, "classification", **SMALL), df)
    assert tr.classification_metrics(scored).first().accuracy > 0.9
    assert tr.task_of("fg_made") == "regression"


def models(spark):
    return spark.createDataFrame([
        ("m1", "qb", "1.0.0", "regression", "active", '{"rmse": 5.0}', 5.0, 1),
        ("m2", "qb", "1.0.9", "regression", "active", '{"mse": 9.0}', 9.0, 3),
        ("m3", "qb", "1.0.2", "regression", "archived", '{"rmse": 1.0}', 1.0, 2),
        ("m4", "wr", "2.1.0", "classification", "active", '{"f1": 0.5, "accuracy": 0.7}', 0.5, 1),
    ], "model_id string, model_name string, version string, model_type string, status string, metrics string, primary_metric double, created_at int")


def test_model_table(spark):
    m = models(spark)
    assert {r.model_name: r.model_id for r in reg.latest_per_key(m, ["model_id"]).collect()} == {"qb": "m2", "wr": "m4"}
    low = reg.best_per_metric(m, ["model_id"], higher_is_better=False)
    assert {r.model_name: r.model_id for r in low.collect()} == {"qb": "m1", "wr": "m4"}  # archived cannot win
    names = spark.createDataFrame([("qb",), ("te",)], "model_name string")
    assert {r.model_name: r.version for r in reg.next_version(m, names).collect()} == {"qb": "1.0.10", "te": "1.0.0"}
    assert [r.model_id for r in reg.list_models(m, model_name="qb").collect()] == ["m2", "m1"]
    assert [r.m for r in m.select(reg.primary_metric().alias("m")).collect()] == [5.0, 9.0, 1.0, 0.5]
    wide = {r.model_id: r for r in reg.compare(m, ["m1", "m4"]).collect()}
    assert wide["m1"].rmse == 5.0 and wide["m1"].f1 is None and wide["m4"].accuracy == 0.7
    new = m.filter("model_id = 'm1'").withColumn("model_id", F.lit("m5"))
    added = reg.append_versions(m, new).first()
    assert added.version == "1.0.10" and added.primary_metric == 5.0


@pytest.fixture()
def tiny_fits(monkeypatch):
    """Notes the positions and sizes that are asked for; fits one small tree in place of each model."""
    asked = []
    whole = tr.estimator

    def fit(df, task="regression", **params):
        asked.append(({r.position for r in df.select("position").distinct().collect()}
                      if "position" in df.columns else set(), params))
        return whole(task, maxIter=1, maxDepth=1).fit(df)

    monkeypatch.setattr(tr, "fit", fit)
    return asked


@pytest.mark.parametrize("name", ["l06_boosted_regression", "l11_feature_importance"])
def test_registered_models_cover_every_position_at_the_defined_size(spark, tiny_fits, name):
    from weekfold.queries import QUERIES

    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert {r.position for r in got.select("position").distinct().collect()} == set(config.POSITION_TARGETS)
    assert set().union(*(p for p, _ in tiny_fits)) == set(config.POSITION_TARGETS)
    assert all(params == {} for _, params in tiny_fits)


def test_registered_search_and_summary_use_the_defaults(spark, monkeypatch):
    from weekfold.queries import QUERIES

    calls = []
    monkeypatch.setattr(tr, "train_all", lambda df, pairs=None, **params: calls.append((pairs, params)))
    QUERIES["l14_training_summary"](spark, "/root/testdata/sf0.001")
    assert calls == [(None, {})]


def test_area_under_roc_spreads_scores_that_lie_close_together(spark):
    """Nine tenths of the scores within a thousandth: no range holds most of them."""
    rng = random.Random(9)
    data = []
    for i in range(6000):
        s = 0.5 + rng.random() * 1e-3 if i % 10 else rng.random()
        data.append((int(rng.random() < s), s))
    df = spark.createDataFrame(data, "label int, score double")
    seen = {}
    whole = tr.settle

    def watched(frame, label):
        out = whole(frame, label)
        if label == "scores":
            seen["slices"] = [r["count"] for r in out.groupBy("_slice").count().collect()]
        return out

    tr.settle = watched
    try:
        got = tr.area_under_roc(df).first().auc
    finally:
        tr.settle = whole
    order = sorted(data, key=lambda x: x[1])
    positives = sum(y for y, _ in data)
    ranks = sum(i + 1 for i, (y, _) in enumerate(order) if y)
    want = (ranks - positives * (positives + 1) / 2) / (positives * (len(data) - positives))
    assert got == pytest.approx(want)
    assert len(seen["slices"]) >= 3 and max(seen["slices"]) < 0.5 * len(data)


def test_area_under_roc_with_ties_and_groups(spark):
    rng = random.Random(4)
    data = [(g, rng.randint(0, 1), rng.choice([0.1, 0.2, 0.2, 0.9])) for g in "ab" for _ in range(60)]
    got = {r.g: r.auc for r in tr.area_under_roc(spark.createDataFrame(data, "g string, label int, score double"), group=["g"]).collect()}
    for g in "ab":
        pos = [s for k, y, s in data if k == g and y]
        neg = [s for k, y, s in data if k == g and not y]
        assert got[g] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))
    # one class alone has no area
    assert tr.area_under_roc(spark.createDataFrame([(1, 0.5)], "label int, score double")).first().auc is None
