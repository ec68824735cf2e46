"""Training, metrics and the model table: l06-l16."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import boosting
from weekfold.operators import registry as reg
from weekfold.operators import selection as sel
from weekfold.operators import training as tr
from weekfold.queries import stages
from weekfold.queries.base_sql import add_table
from weekfold.queries.features import rounded
from weekfold.queries.registry import query
from weekfold.session import scratch_path
from weekfold.sources import stand_ins as src


#: The common target, or the first one of a position without it.
_TARGET = {p: "fantasy_points_ppr" if "fantasy_points_ppr" in own else own[0] for p, own in config.POSITION_TARGETS.items()}
_LEAST = config.MIN_TRAINING_ROWS


def _frames(spark, root):
    """The rows of every position with its target; ``model`` is the position."""
    return tr.to_ml_frames(stages.training(spark, root), list(_TARGET.items())).withColumn("model", F.col("position"))


def _train(df):
    return df.filter(F.col("split") == "train")


def _models(spark, root):
    """One run for all positions, kept with the session as the other stages are."""
    return stages.kept(spark, root, "position models", lambda: tr.fit(_train(_frames(spark, root))))


# rows with the target of their position
add_table("position_labels", ("split_features", "outcome_rows"), """
SELECT f.feature_id, f.position, f.season, f.split, coalesce(o.value, 0.0) AS label FROM split_features f
LEFT JOIN outcome_rows o ON o.feature_id = f.feature_id AND o.target = CASE f.position """
          + " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in _TARGET.items()) + """ END
WHERE f.position IN (""" + ", ".join(f"'{p}'" for p in _TARGET) + ")")
add_table("trained_positions", ("position_labels",), f"""
SELECT position FROM position_labels GROUP BY position HAVING count(*) FILTER (split = 'train') >= {_LEAST}""")


@query("l06_boosted_regression")
def l06(spark, root):
    return tr.score(tr.fit(_train(_frames(spark, root))), _frames(spark, root)).select(
        "feature_id", "position", "split", "label", "prediction"
    )


@query("l06_fit_by_split", """
SELECT position, split, count(*) AS n, round(sum(label), 3) AS label_sum,
  CASE WHEN position IN (SELECT position FROM trained_positions) THEN count(*) ELSE 0 END AS predicted,
  CASE WHEN position IN (SELECT position FROM trained_positions) AND split = 'train' THEN true END AS better_than_mean
FROM position_labels GROUP BY position, split""", ["position_labels", "trained_positions"])
def l06_by_split(spark, root):
    """Rows and labels that the models saw; on the rows they were fitted on they must beat the mean."""
    scored = tr.score(_models(spark, root), _frames(spark, root))
    error = F.sum((F.col("label") - F.col("prediction")) ** 2)
    return scored.groupBy("position", "split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("label"), 3).alias("label_sum"), F.count("prediction").alias("predicted"),
        (error <= F.var_pop("label") * F.count("label")).alias("better"),
    ).select("position", "split", "n", "label_sum", "predicted",
             F.when(F.col("split") == "train", F.col("better")).alias("better_than_mean"))


def _labelled_vectors(spark, root):
    e = src.table(spark, root, "embeddings")
    return e.select(
        "vec_id", tr.array_to_vector("embedding").alias("features"),
        (F.col("label") % 2).cast("double").alias("label"), F.lit("odd label").alias("model"),
    )


def _classified(spark, root):
    df = _labelled_vectors(spark, root)
    model = stages.kept(spark, root, "vector classifier", lambda: tr.fit(df, "classification"))
    return tr.score(model, df)


@query("l07_boosted_classification")
def l07(spark, root):
    return _classified(spark, root).select("vec_id", "label", "prediction")


@query("l07_fit_by_label", """
SELECT CAST(label % 2 AS DOUBLE) AS label, count(*) AS n, count(*) AS predicted, true AS mostly_right
FROM embeddings GROUP BY label % 2""")
def l07_by_label(spark, root):
    scored = _classified(spark, root)
    right = F.count_if(F.col("label") == F.col("prediction"))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("predicted"),
        (right > 0.7 * F.count(F.lit(1))).alias("mostly_right"),
    )


# predictions whose value is known in both engines: last month's count
add_table("naive_forecast", ("order_games",), """
SELECT player_id, season, week, CAST(fantasy_points AS DOUBLE) AS label, CAST(lag(fantasy_points) OVER (PARTITION BY player_id ORDER BY season, week) AS DOUBLE) AS prediction
FROM order_games""")


def naive_forecast(spark, root):
    w = Window.partitionBy("player_id").orderBy("season", "week")
    return src.order_games(spark, root).select(
        "player_id", "season", "week", F.col("fantasy_points").alias("label"),
        F.lag("fantasy_points").over(w).alias("prediction"),
    ).dropna()


@query("l08_regression_metrics", """
SELECT CAST(season AS BIGINT) AS season, count(*) AS n, round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse, round(avg(abs(label - prediction)), 6) AS mae,
  round(avg((label - prediction) ** 2), 6) AS mse, round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 6) AS r2
FROM naive_forecast WHERE prediction IS NOT NULL GROUP BY season""", ["naive_forecast"])
def l08(spark, root):
    return rounded(tr.regression_metrics(naive_forecast(spark, root), group=["season"]))


_CLASSES = """(SELECT CAST(label > 250 AS INTEGER) + CAST(label > 400 AS INTEGER) AS label,
  CAST(prediction > 250 AS INTEGER) + CAST(prediction > 400 AS INTEGER) AS prediction FROM naive_forecast WHERE prediction IS NOT NULL)"""


@query("l09_classification_metrics", f"""
WITH c AS {_CLASSES},
k AS (SELECT x.c, (SELECT count(*) FROM c WHERE label = x.c) AS support, (SELECT count(*) FROM c WHERE prediction = x.c) AS called,
  (SELECT count(*) FROM c WHERE prediction = x.c AND label = x.c) AS hits FROM (SELECT unnest([0, 1, 2]) AS c) x),
m AS (SELECT *, coalesce(hits / nullif(CAST(called AS DOUBLE), 0), 0) AS p, coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS r FROM k)
SELECT (SELECT count(*) FROM c) AS n, round((SELECT avg(CAST(label = prediction AS INTEGER)) FROM c), 6) AS accuracy,
  round(max(p) FILTER (c = 1), 6) AS precision, round(max(r) FILTER (c = 1), 6) AS recall,
  round(sum(p * support) / sum(support), 6) AS weighted_precision, round(sum(r * support) / sum(support), 6) AS weighted_recall,
  round(sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * support) / sum(support), 6) AS weighted_f1 FROM m""", ["naive_forecast"])
def l09(spark, root):
    def klass(c):
        return (F.col(c) > 250).cast("int") + (F.col(c) > 400).cast("int")

    rows = naive_forecast(spark, root).select(klass("label").alias("label"), klass("prediction").alias("prediction"))
    return rounded(tr.classification_metrics(rows))


@query("l09_area_under_roc", """
SELECT season, round(sum(CASE WHEN p.prediction > q.prediction THEN 1.0 WHEN p.prediction = q.prediction THEN 0.5 ELSE 0.0 END) / count(*), 6) AS auc
FROM (SELECT CAST(season AS BIGINT) AS season, prediction FROM naive_forecast WHERE prediction IS NOT NULL AND label > 300) p
JOIN (SELECT CAST(season AS BIGINT) AS season, prediction FROM naive_forecast WHERE prediction IS NOT NULL AND label <= 300) q USING (season)
GROUP BY season""", ["naive_forecast"])
def l09_auc(spark, root):
    rows = naive_forecast(spark, root).withColumn("label", (F.col("label") > 300).cast("int"))
    return rounded(tr.area_under_roc(rows, score_col="prediction", group=["season"]))


@query("l10_batch_score")
def l10(spark, root):
    return _classified(spark, root).select("vec_id", "prediction", "probability")


@query("l10_score_checks", """
SELECT count(*) AS n, 0 AS outside, 0 AS disagreeing, 0 AS missing FROM embeddings""")
def l10_checks(spark, root):
    """Probabilities lie between 0 and 1, and the prediction is their side of a half."""
    p = F.col("probability")
    return _classified(spark, root).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((p < 0) | (p > 1)).alias("outside"),
        F.count_if((p > 0.5) != (F.col("prediction") == 1)).alias("disagreeing"), F.count_if(p.isNull()).alias("missing"),
    )


@query("l11_feature_importance")
def l11(spark, root):
    models = tr.fit(_train(_frames(spark, root)))
    return reduce(DataFrame.unionByName, [
        tr.importance(models, config.vector_names(p), p).select(F.lit(p).alias("position"), "feature", "importance")
        for p in config.POSITION_TARGETS
    ])


@query("l11_importance_checks", """
SELECT position, CAST(47 AS BIGINT) AS features, CAST(1.0 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS negative FROM trained_positions""", ["trained_positions"])
def l11_checks(spark, root):
    models = _models(spark, root)
    rows = [
        (p, len(config.vector_names(p)), float(v)) for p in models.specs for v in models.importance(p)
    ]
    return spark.createDataFrame(rows, "position string, width int, importance double").groupBy("position").agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"),
    )


_TRIALS = 50


def _search(spark, root):
    return stages.kept(spark, root, "search", lambda: sel.search(
        _frames(spark, root), tr.tree_settings(), trials=_TRIALS, least_rows=_LEAST
    ))


@query("l12_hyperparameter_search")
def l12(spark, root):
    found = _search(spark, root)
    rows = [
        (p, trial, trees, s.depth, s.rate, s.rows, s.columns, s.least_weight, s.gamma, s.alpha, s.penalty, score)
        for p, trial, rung, trees, score, kept in found.history if kept and rung == len(sel.RUNGS) - 1
        for s in [found.best.specs[p].settings]
    ]
    return spark.createDataFrame(
        rows, "position string, trial int, trees int, max_depth int, rate double, rows double, columns double, "
        "least_weight double, gamma double, alpha double, penalty double, rmse double"
    )


@query("l12_search_rungs", f"""
WITH searched AS (
  SELECT position FROM position_labels GROUP BY position
  HAVING count(*) FILTER (split = 'train') >= {_LEAST} AND count(*) FILTER (split = 'validation') >= {_LEAST}
)
SELECT position, rung, CAST(n AS BIGINT) AS trials, CAST(kept AS BIGINT) AS kept, true AS best_kept
FROM searched, (VALUES (0, 50, 25), (1, 25, 13), (2, 13, 7), (3, 7, 1)) r(rung, n, kept)""", ["position_labels"])
def l12_rungs(spark, root):
    """Trials of each rung; those that go on are never worse than those that end."""
    history = spark.createDataFrame(
        _search(spark, root).history, "position string, trial int, rung int, trees int, rmse double, kept boolean"
    )
    last = F.max(F.when(F.col("kept"), F.col("rmse")))
    first = F.min(F.when(~F.col("kept"), F.col("rmse")))
    return history.groupBy("position", "rung").agg(
        F.count(F.lit(1)).alias("trials"), F.count_if("kept").alias("kept"), (last <= first).alias("best_kept")
    )


def _fold_scores(spark, root):
    return stages.stage(spark, root, "fold scores", lambda: sel.fold_scores(
        sel.season_folds(_frames(spark, root)), tr.tree_settings(), least_rows=_LEAST
    ))


@query("l13_cross_validation")
def l13(spark, root):
    return sel.cross_validated(_fold_scores(spark, root)).withColumnRenamed("model", "position")


@query("l13_fold_sizes", f"""
WITH folds AS (
  SELECT position, (dense_rank() OVER (ORDER BY season) - 1) % 5 AS fold FROM position_labels
), sizes AS (SELECT position, fold, count(*) AS n, sum(count(*)) OVER (PARTITION BY position) AS total FROM folds GROUP BY position, fold)
SELECT position, CAST(fold AS INTEGER) AS fold, CAST(total - n AS BIGINT) AS fitted, n, true AS scored
FROM sizes WHERE total >= {_LEAST} AND total > n""", ["position_labels"])
def l13_sizes(spark, root):
    return _fold_scores(spark, root).select(
        F.col("model").alias("position"), "fold", "fitted", "n", (F.col("score") > 0).alias("scored")
    )


@query("l14_training_summary")
def l14(spark, root):
    return tr.train_all(stages.training(spark, root))


_PAIRS_SQL = ", ".join(f"('{p}', '{t}')" for p, own in config.POSITION_TARGETS.items() for t in own)


@query("l14_pair_status", f"""
WITH pairs AS (SELECT * FROM (VALUES {_PAIRS_SQL}) x(position, target)),
counts AS (SELECT position, split, count(*) AS n FROM split_features GROUP BY position, split),
enough AS (SELECT position FROM counts WHERE split = 'train' AND n >= {_LEAST})
SELECT position, target, 'trained' AS status, split, n FROM pairs JOIN counts USING (position) WHERE position IN (SELECT position FROM enough)
UNION ALL SELECT position, target, 'skipped', NULL, 0 FROM pairs WHERE position NOT IN (SELECT position FROM enough)""", ["split_features"])
def l14_status(spark, root):
    return stages.stage(spark, root, "training summary", lambda: tr.train_all(stages.training(spark, root))).select(
        "position", "target", "status", "split", "n"
    )


@query("l15_model_round_trip", """
SELECT position, count(*) AS n, CAST(0.0 AS DOUBLE) AS largest_difference, CAST(47 AS BIGINT) AS features
FROM position_labels WHERE position IN (SELECT position FROM trained_positions) GROUP BY position""", ["position_labels", "trained_positions"])
def l15(spark, root):
    """Predictions before saving against those of the models that were read back."""
    models, path = _models(spark, root), scratch_path(spark, "model")
    tr.keep(models, path)
    again = boosting.Models.load(spark, path)
    rows = _frames(spark, root).filter(F.col("position").isin(list(models.specs)))
    both = tr.score(again, tr.score(models, rows).withColumnRenamed("prediction", "before"))
    widths = spark.createDataFrame([
        (p, spark.read.parquet(f"{path}/{p}/features").count()) for p in models.specs
    ], "position string, features long")
    return both.groupBy("position").agg(
        F.count("prediction").alias("n"), F.max(F.abs(F.col("prediction") - F.col("before"))).alias("largest_difference")
    ).join(F.broadcast(widths), "position")


# --- the model table: one "model" per part brand, one version per part --------------------
add_table("models", (), """
SELECT p_partkey AS model_id, p_brand AS model_name, '1.' || (p_size % 3) || '.' || (p_partkey % 40) AS version,
  CASE WHEN p_partkey % 2 = 0 THEN 'regression' ELSE 'classification' END AS model_type,
  CASE WHEN p_size % 5 = 0 THEN 'archived' ELSE 'active' END AS status,
  CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END END AS rmse,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size * p_size AS DOUBLE) END AS mse,
  CASE WHEN p_partkey % 2 = 1 THEN p_size / 100.0 END AS f1,
  p_partkey % 365 AS created_at
FROM part""")
_PRIMARY = "CASE model_type WHEN 'regression' THEN coalesce(rmse, mse, 0.0) ELSE coalesce(f1, 0.0) END"


def models(spark, root):
    p = src.table(spark, root, "part")
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    even = key % 2 == 0
    metrics = F.to_json(F.struct(
        F.when(even & (key % 3 != 0), size).alias("rmse"), F.when(even, size * size).alias("mse"),
        F.when(~even, size / 100.0).alias("f1"),
    ))
    base = p.select(
        key.alias("model_id"), F.col("p_brand").alias("model_name"),
        F.concat(F.lit("1."), (F.col("p_size") % 3).cast("string"), F.lit("."), (key % 40).cast("string")).alias("version"),
        F.when(even, F.lit("regression")).otherwise(F.lit("classification")).alias("model_type"),
        F.when(F.col("p_size") % 5 == 0, F.lit("archived")).otherwise(F.lit("active")).alias("status"),
        metrics.alias("metrics"), (key % 365).alias("created_at"),
    )
    return base.withColumn("primary_metric", reg.primary_metric())


@query("l16_latest_version", """
SELECT model_name, model_id, version FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, model_id DESC) AS r FROM models)
WHERE r = 1""", ["models"])
def l16_latest(spark, root):
    return reg.latest_per_key(models(spark, root), ["model_id", "version"])


@query("l16_best_model", f"""
SELECT model_name, model_id, primary_metric FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY primary_metric, model_id) AS r
  FROM (SELECT *, CAST({_PRIMARY} AS DOUBLE) AS primary_metric FROM models WHERE status = 'active' AND model_type = 'regression')) WHERE r = 1""", ["models"])
def l16_best(spark, root):
    rows = models(spark, root).filter(F.col("model_type") == "regression")
    return reg.best_per_metric(rows, ["model_id", "primary_metric"], higher_is_better=False)


@query("l16_list_models", """
SELECT model_id, model_name, version, created_at FROM models WHERE status = 'active' AND model_type = 'classification'
ORDER BY created_at DESC, model_id DESC LIMIT 100""", ["models"])
def l16_list(spark, root):
    return reg.list_models(models(spark, root), model_type="classification").select(
        "model_id", "model_name", "version", "created_at"
    )


@query("l16_compare_models", f"""
SELECT model_id, model_name, version, model_type, CAST({_PRIMARY} AS DOUBLE) AS primary_metric, CAST(rmse AS DOUBLE) AS rmse, CAST(f1 AS DOUBLE) AS f1
FROM models""", ["models"])
def l16_compare(spark, root):
    from weekfold.functions.nested import widen_metrics

    rows = models(spark, root).select("model_id", "model_name", "version", "model_type", "metrics", "primary_metric")
    return widen_metrics(rows, "metrics", ["rmse", "f1"]).drop("metrics")


@query("l16_next_version", """
SELECT n.model_name, coalesce(split_part(m.version, '.', 1) || '.' || split_part(m.version, '.', 2) || '.' || (CAST(split_part(m.version, '.', 3) AS INTEGER) + 1), '1.0.0') AS version
FROM (SELECT DISTINCT p_brand AS model_name FROM part UNION SELECT DISTINCT p_type FROM part) n
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, model_id DESC) AS r FROM models) WHERE r = 1) m
  ON m.model_name = n.model_name""", ["models"])
def l16_next(spark, root):
    p = src.table(spark, root, "part")
    names = p.select(F.col("p_brand").alias("model_name")).union(p.select("p_type")).distinct()
    return reg.next_version(models(spark, root), names)
