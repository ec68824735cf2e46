"""From feature rows to models: reading, fitting, scoring, metrics, selection."""

from __future__ import annotations

import random
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold import config
from weekfold.operators import boosting
from weekfold.operators.joins import with_one_row
from weekfold.session import settle


# --- reading -------------------------------------------------------------------------
def training_set(
    df: DataFrame, season_start: int, season_end: int,
    min_quality: float = config.MIN_QUALITY, position: str | None = None, in_order: bool = False,
) -> DataFrame:
    """Rows with outcomes in a season range, good enough; ``in_order`` sorts them by time, which fitting does not need."""
    rows = df.filter(
        F.col("season").between(season_start, season_end)
        & F.col("outcomes").isNotNull()
        & (F.coalesce("quality", F.lit(1.0)) >= min_quality)
    )
    if position is not None:
        rows = rows.filter(F.col("position") == position)
    return rows.orderBy("season", "week", "feature_id") if in_order else rows


def label_of(target: str) -> Column:
    """The target's outcome; missing counts as 0."""
    return F.coalesce(F.element_at("outcomes", target), F.lit(0.0))


def to_ml_frame(df: DataFrame, target: str) -> DataFrame:
    return df.select(
        "feature_id", "position", "season", "week",
        *[c for c in ("split",) if c in df.columns],
        array_to_vector("numerical").alias("features"), label_of(target).alias("label"),
    )


def to_ml_frames(df: DataFrame, pairs) -> DataFrame:
    """One row per feature row and (position, target) pair of its position, named in ``model``."""
    marks = F.array(*[
        F.struct(F.lit(f"{p}/{t}").alias("model"), F.lit(p).alias("of"), F.lit(t).alias("target"), label_of(t).alias("label"))
        for p, t in pairs
    ])
    own = F.filter(marks, lambda m: m["of"] == F.col("position"))
    return df.select(
        "feature_id", "position", "season", "week", *[c for c in ("split", "fold") if c in df.columns],
        array_to_vector("numerical").alias("features"), F.explode(own).alias("m"),
    ).select("*", "m.model", "m.target", "m.label").drop("m")


def target_rows(df: DataFrame) -> DataFrame:
    """One row per feature row and trained target of its position."""
    names = F
    for p, targets in config.POSITION_TARGETS.items():
        names = names.when(F.col("position") == p, F.array(*[F.lit(t) for t in targets]))
    listed = df.withColumn("target", F.explode(names.otherwise(F.lit(None))))
    return listed.withColumn(
        "label", F.coalesce(F.element_at("outcomes", F.col("target")), F.lit(0.0))
    )


def task_of(target: str) -> str:
    """A made-field-goal count is a number, so it is a regression target."""
    return "classification" if target in config.CLASSIFICATION_TARGETS else "regression"


# --- fitting and scoring ---------------------------------------------------------------
def estimator(task: str = "regression", **params):
    base = config.REGRESSION_TREES if task == "regression" else config.CLASSIFICATION_TREES
    kind = GBTRegressor if task == "regression" else GBTClassifier
    return kind(featuresCol="features", labelCol="label", **{**base, **params})


def tree_settings(task: str = "regression", **params) -> boosting.Settings:
    """The configured settings of trees for many models at once, with Spark's parameter names or ours in ``params``."""
    base = config.REGRESSION_TREES if task == "regression" else config.CLASSIFICATION_TREES
    return boosting.settings(task, **{**base, **config.TREE_PENALTIES, **params})


def fit(df: DataFrame, task: str = "regression", **params):
    """Fit boosted trees; a ``validation`` flag column enables early stopping.

    With a column ``model`` all its values get a model of their own in one run
    (``boosting.Models``); values with too few rows get none.

    Returns None when there are too few rows. Input is expected to be a stored
    table or a short plan: boosting reads it once per tree level.
    """
    if "model" in df.columns:
        return boosting.fit(df, tree_settings(task, **params), least_rows=config.MIN_TRAINING_ROWS)
    if df.limit(config.MIN_TRAINING_ROWS).count() < config.MIN_TRAINING_ROWS:
        return None
    if "is_validation" in df.columns:
        params = {"validationIndicatorCol": "is_validation", **params}
    return estimator(task, **params).fit(df)


def score(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def importance(model, names, of: str | None = None) -> DataFrame:
    """Feature importances, highest first (sized by the number of features).

    ``of`` names the model among many; one that does not exist has no rows.
    """
    from pyspark.sql import SparkSession

    if isinstance(model, boosting.Models):
        values = [float(v) for v in model.importance(of)] if of in model.nodes else []
        names = names if values else []
    else:
        values = [float(v) for v in model.featureImportances.toArray()]
    rows = SparkSession.getActiveSession().createDataFrame(
        list(zip(names, values, strict=True)), "feature string, importance double"
    )
    return rows.orderBy(F.desc("importance"), "feature")


# --- metrics ----------------------------------------------------------------------------
def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", group=()) -> DataFrame:
    """rmse, mae, mse and r2 as plain aggregates, per group if given."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    total = F.var_pop(y) * F.count(y)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        (F.lit(1.0) - F.sum(e * e) / F.nullif(total, F.lit(0.0))).alias("r2"),
    )


def confusion(df: DataFrame, label: str, prediction: str, group=()) -> DataFrame:
    return df.groupBy(*group, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", group=()) -> DataFrame:
    """Accuracy, precision and recall of class 1, and support-weighted P/R/F1.

    Everything after the confusion counts works on classes x classes rows; these
    are written, so the input is read once.
    """
    cells = settle(confusion(df, label, prediction, group), "confusion")
    n = F.col("n")
    hit = F.col("label") == F.col("prediction")
    overall = cells.groupBy(*group).agg(
        F.sum(n).alias("n"), F.sum(F.when(hit, n)).alias("_hits"),
        F.sum(F.when((F.col("label") == 1) & (F.col("prediction") == 1), n)).alias("_tp"),
        F.sum(F.when(F.col("prediction") == 1, n)).alias("_pp"),
        F.sum(F.when(F.col("label") == 1, n)).alias("_ap"),
    )
    # each cell counts towards the class it is and the class it was called
    marks = cells.select(*group, F.explode(F.array(
        F.struct(F.col("label").alias("c"), n.alias("support"), F.lit(0).cast("bigint").alias("called"),
                 F.when(hit, n).otherwise(F.lit(0)).alias("right")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("support"), n.alias("called"),
                 F.lit(0).cast("bigint").alias("right")),
    )).alias("m")).select(*group, "m.*")
    per_class = marks.groupBy(*group, "c").agg(*[F.sum(x).alias(x) for x in ("support", "called", "right")])

    def rate(a, b):
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))

    p, r = rate(F.col("right"), F.col("called")), rate(F.col("right"), F.col("support"))
    f1 = F.coalesce(2 * p * r / F.nullif(p + r, F.lit(0.0)), F.lit(0.0))
    weighted = per_class.groupBy(*group).agg(*[
        (F.sum(v * F.col("support")) / F.sum("support")).alias(name)
        for name, v in (("weighted_precision", p), ("weighted_recall", r), ("weighted_f1", f1))
    ])
    joined = overall.join(weighted, list(group)) if group else with_one_row(overall, weighted)
    zero = F.lit(0)
    return joined.select(
        *group, "n",
        rate(F.coalesce("_hits", zero), F.col("n")).alias("accuracy"),
        rate(F.coalesce("_tp", zero), F.col("_pp")).alias("precision"),
        rate(F.coalesce("_tp", zero), F.col("_ap")).alias("recall"),
        "weighted_precision", "weighted_recall", "weighted_f1",
    )


def area_under_roc(df: DataFrame, label: str = "label", score_col: str = "score", group=()) -> DataFrame:
    """Area under the ROC curve from counts per distinct score.

    Negatives below a score plus half of those at it, summed over positives.
    Scores are counted first, then dealt out in ranges that are sampled from
    them: wherever scores lie close together the ranges are narrow, so even
    all-distinct scores of one group are spread over many tasks. Only totals of
    ranges are accumulated over a group, and scores inside their range. The
    ranges are written once, which fixes them.
    """
    counted = df.groupBy(*group, F.col(score_col).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_score = settle(
        counted.repartitionByRange(ranges, *group, "s").withColumn("_slice", F.spark_partition_id()), "scores"
    )
    before = Window.orderBy("_slice") if not group else Window.partitionBy(*group).orderBy("_slice")
    totals = per_score.groupBy(*group, "_slice").agg(F.sum("neg").alias("_neg"))
    starts = totals.select(
        *group, "_slice",
        F.coalesce(F.sum("_neg").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per_score.join(starts, [*group, "_slice"]).withColumn(
        "under", F.col("_start") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    )
    wins = F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*group).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc"))


# --- selection ---------------------------------------------------------------------------
def random_grid(model, trials: int, seed: int = 42, depth=(3, 10), rate=(0.01, 0.3), trees=(100, 500)):
    """A seeded random sample of the search space, as parameter maps."""
    rng = random.Random(seed)
    grid = []
    for _ in range(trials):
        grid += (
            ParamGridBuilder()
            .baseOn({model.maxDepth: rng.randint(*depth)})
            .baseOn({model.stepSize: rate[0] * (rate[1] / rate[0]) ** rng.random()})
            .baseOn({model.maxIter: rng.randint(*trees)})
            .baseOn({model.subsamplingRate: rng.uniform(0.6, 1.0)})
            .baseOn({model.minInstancesPerNode: rng.randint(1, 10)})
            .build()
        )
    return grid


def _evaluator(task: str, metric: str | None = None):
    if task == "regression":
        return RegressionEvaluator(labelCol="label", metricName=metric or "rmse")
    return BinaryClassificationEvaluator(labelCol="label", metricName=metric or "areaUnderROC")


@dataclass
class Search:
    """Outcome of ``tune``: the best model, and the metric of every trial in their order."""

    bestModel: object
    validationMetrics: list[float]


def tune(
    df: DataFrame, task: str = "regression", trials: int = 50, parallelism: int = 4, seed: int = 42,
    metric: str | None = None, **space,
) -> Search:
    """Best model of a seeded random search in time order.

    Trials are fitted on the rows whose ``split`` is train and judged on those
    of validation, which are later, so no later row helps to choose a model for
    earlier ones. Depth, step size, number of trees, row sampling and the least
    rows of a leaf are searched; column sampling per tree and the penalties of
    other libraries have no counterpart in Spark's trees.
    """
    if "split" not in df.columns:
        raise ValueError("searching in time order needs a split column")
    train, validation = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "validation")
    model, evaluator = estimator(task), _evaluator(task, metric)

    def trial(params):
        fitted = model.fit(train, params)
        return fitted, evaluator.evaluate(fitted.transform(validation))

    with ThreadPool(max(1, min(parallelism, trials))) as pool:
        outcomes = pool.map(trial, random_grid(model, trials, seed, **space))
    best = max if evaluator.isLargerBetter() else min
    return Search(best(outcomes, key=lambda o: o[1])[0], [m for _, m in outcomes])


def cross_validate(
    df: DataFrame, task: str = "regression", folds: int = 5, parallelism: int = 4, seed: int = 42,
    fold_col: str | None = None, metric: str | None = None, **params,
) -> DataFrame:
    """Mean and deviation of the score over folds; one row.

    ``fold_col`` names an integer column with each row's fold, such as the
    season's number, so that rows of one period stay together; without it rows
    are dealt at random.
    """
    model = estimator(task, **params)
    by = {"foldCol": fold_col} if fold_col else {}
    fitted = CrossValidator(
        estimator=model, estimatorParamMaps=[{}], evaluator=_evaluator(task, metric),
        numFolds=folds, parallelism=parallelism, seed=seed, **by,
    ).fit(df)
    return df.sparkSession.createDataFrame(
        [(folds, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))],
        "folds int, mean_score double, std_score double",
    )


# --- many models ------------------------------------------------------------------------
def train_all(df: DataFrame, pairs=None, models_path: str | None = None, **params) -> DataFrame:
    """Fit one model per (position, target), all in one run; one metrics row per pair and split.

    With ``models_path`` the models are kept there (``boosting.Models.load``
    reads them), and the feature names of each pair under
    ``<position>/<target>/features``. Pairs with too few rows are listed as
    skipped. ``df`` should be a stored table with ``split``.
    """
    pairs = pairs or [(p, t) for p, names in config.POSITION_TARGETS.items() for t in names]
    unknown = {p for p, _ in pairs} - set(config.POSITION_TARGETS)
    if unknown:
        raise ValueError(f"unknown positions {sorted(unknown)}")
    if df.isEmpty():
        raise ValueError("the training set is empty")
    rows = to_ml_frames(df, pairs)
    models = boosting.fit(
        rows.filter(F.col("split") == "train"), lambda name: tree_settings(task_of(name.split("/")[1]), **params),
        least_rows=config.MIN_TRAINING_ROWS, alike=lambda name: name.split("/")[0],
    )
    if models_path:
        keep(models, models_path)
    scored = models.transform(rows).filter(F.col("model").isin(list(models.specs)))
    trained = regression_metrics(scored, group=["position", "target", "split"]).select(
        "position", "target", F.lit("trained").alias("status"), "split", "n", "rmse", "mae", "r2"
    )
    left = [(p, t, "skipped", None, 0, None, None, None) for p, t in pairs if f"{p}/{t}" not in models.specs]
    return trained.unionByName(df.sparkSession.createDataFrame(
        left, "position string, target string, status string, split string, n long, rmse double, mae double, r2 double"
    ))


def keep(models: boosting.Models, path: str) -> None:
    """Write models named ``position/target`` and the feature names of each."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    models.save(spark, path)
    for name in models.specs:
        _write_names(spark, f"{path}/{name}/features", config.vector_names(name.split("/")[0]))


def model_rows(summary: DataFrame, created_at: Column, path: str, split: str = "validation") -> DataFrame:
    """Rows for the model table from the summary of ``train_all``, judged on one split.

    ``registry.append_versions`` gives them their versions.
    """
    name = F.concat_ws("_", "position", "target")
    return summary.filter((F.col("status") == "trained") & (F.col("split") == split)).select(
        F.concat_ws("-", name, F.date_format(created_at, "yyyyMMddHHmmss")).alias("model_id"), name.alias("model_name"),
        F.lit("regression").alias("model_type"), F.lit("active").alias("status"),
        F.to_json(F.struct("rmse", "mae", "r2", "n")).alias("metrics"), F.lit(path).alias("model_path"),
        created_at.alias("created_at"),
    )


# --- storage ----------------------------------------------------------------------------
def save(model, path: str, names) -> None:
    """Model and its feature names, both on shared storage."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    _write_names(SparkSession.getActiveSession(), f"{path}/features", names)


def _write_names(spark, path: str, names) -> None:
    spark.createDataFrame(list(enumerate(names)), "slot int, name string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark, path: str, task: str = "regression"):
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import GBTRegressionModel

    kind = GBTRegressionModel if task == "regression" else GBTClassificationModel
    names = spark.read.schema("slot int, name string").parquet(f"{path}/features").orderBy("slot")
    return kind.load(f"{path}/model"), [r.name for r in names.toLocalIterator()]
