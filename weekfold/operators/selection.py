"""Choosing models: successive halving and folds, for many models at once."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekfold.operators import boosting as bo
from weekfold.operators import training as tr

#: Name -> (column of the metrics tables, sign); a larger score is better with sign 1.
SCORERS = {
    "rmse": ("rmse", -1), "mse": ("mse", -1), "mae": ("mae", -1), "r2": ("r2", 1),
    "neg_mean_squared_error": ("mse", 1), "neg_root_mean_squared_error": ("rmse", 1),
    "neg_mean_absolute_error": ("mae", 1), "auc": ("auc", 1), "accuracy": ("accuracy", 1),
    "precision_weighted": ("weighted_precision", 1), "recall_weighted": ("weighted_recall", 1),
    "f1_weighted": ("weighted_f1", 1),
}
_REGRESSION = ("rmse", "mse", "mae", "r2")
#: Shares of a trial's trees after which the worse half of the trials ends.
RUNGS = (0.125, 0.25, 0.5, 1.0)


def scores(scored: DataFrame, scorer: str, group: list[str]) -> DataFrame:
    """(group, n, score) of rows with label and margin; ``neg_`` scorers have the sign turned."""
    column, _ = SCORERS[scorer]
    sign = -1 if scorer.startswith("neg_") else 1
    counts = scored.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    if column in _REGRESSION:
        found = tr.regression_metrics(scored, prediction="margin", group=group).drop("n")
    elif column == "auc":
        found = tr.area_under_roc(scored, score_col="margin", group=group)
    else:
        called = scored.withColumns({"prediction": (F.col("margin") > 0).cast("int"), "label": F.col("label").cast("int")})
        found = tr.classification_metrics(called, group=group).drop("n")
    return counts.join(found, group).select(*group, "n", (sign * F.col(column)).alias("score"))


def random_settings(base: bo.Settings, trials: int, seed: int = 42, depth=(3, 10), trees=(100, 500)) -> list[bo.Settings]:
    """A seeded random sample of the whole space."""
    rng = random.Random(seed)
    out = []
    for i in range(trials):
        out.append(replace(
            base, depth=rng.randint(*depth), rate=0.01 * 30.0 ** rng.random(), trees=rng.randint(*trees),
            rows=rng.uniform(0.6, 1.0), columns=rng.uniform(0.6, 1.0), least_weight=float(rng.randint(1, 10)),
            gamma=rng.random(), alpha=rng.random(), penalty=2 * rng.random(),
            positive_weight=rng.uniform(0.5, 2.0) if base.task == "classification" else 1.0, seed=seed + i,
        ))
    return out


@dataclass
class Halving:
    """The best model of each frame, and a row (model, trial, rung, trees, score, kept) for each trial and rung."""

    best: bo.Models
    history: list[tuple]


def search(
    df: DataFrame, base: bo.Settings, trials: int = 50, seed: int = 42, scorer: str | None = None,
    rungs: tuple[float, ...] = RUNGS, least_rows: int = 1, local_rows: int | None = None, **space,
) -> Halving:
    """Successive halving over random settings for every value of ``model``, all trials growing together.

    Trials are fitted on the rows whose ``split`` is train and judged on those of
    validation, which are later. At each rung, a share of a trial's own trees,
    the better half goes on from its trees; ``rungs=(1.0,)`` runs all to the end.
    Values with fewer than ``least_rows`` rows in either part take no part. Ties
    go to the earlier trial.
    """
    if "split" not in df.columns:
        raise ValueError("searching in time order needs a split column")
    scorer = scorer or ("rmse" if base.task == "regression" else "auc")
    part = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1)
    rows = bo.frame_rows(df, "model", part=part)
    frames = {
        n: f for n, f in bo.frames_of(rows).items() if min(f.rows([0]), f.rows([1])) >= least_rows
    }
    if not frames:
        return Halving(bo.Models({}, {}, {}), [])
    stored = bo.binned(rows, frames)
    drawn = random_settings(base, trials, seed, **space)
    alive = {name: list(range(trials)) for name in frames}
    grown: dict = {}
    history, sign = [], SCORERS[scorer][1]
    for rung, share in enumerate(rungs):
        specs = [
            bo.specified(frames, f"{name}/{i}", name, replace(drawn[i], trees=math.ceil(share * drawn[i].trees)))
            for name, own in alive.items() for i in own
        ]
        grown = bo.grow(stored, specs, frames, grown, local_rows=local_rows)
        models = bo.Models({s.name: s for s in specs}, frames, grown)
        judged = models.scores(stored.where("part = 1"), ["label"], "label double")
        # one row for each trial that is left
        found = {r.model: r.score for r in scores(judged, scorer, ["model"]).collect()}
        for name, own in alive.items():
            def worse(i: int, name=name) -> tuple:
                value = found[f"{name}/{i}"]
                return (math.inf if value is None or math.isnan(value) else -sign * value, i)

            left = sorted(own, key=worse)[:1 if rung == len(rungs) - 1 else math.ceil(len(own) / 2)]
            history += [
                (name, i, rung, models.trees(f"{name}/{i}"), found[f"{name}/{i}"], i in left) for i in own
            ]
            alive[name] = left
    best = {name: models.specs[f"{name}/{own[0]}"] for name, own in alive.items()}
    return Halving(
        bo.Models(
            {n: replace(s, name=n) for n, s in best.items()}, frames, {n: grown[s.name] for n, s in best.items()}
        ),
        history,
    )


def season_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """``df`` with a ``fold``: seasons in turn, so that the rows of one season stay together."""
    seasons = df.select("season").distinct()  # a row for each season
    numbered = seasons.withColumn(
        "fold", ((F.row_number().over(Window.orderBy("season")) - 1) % folds).cast("int")
    )
    return df.join(numbered, "season")


def fold_scores(
    df: DataFrame, chosen: bo.Settings, folds: int = 5, scorer: str | None = None, least_rows: int = 1,
    local_rows: int | None = None,
) -> DataFrame:
    """(model, fold, fitted, n, score): every value of ``model`` judged on each of its folds.

    All folds of all models grow together over one table of binned rows; the
    model of a fold takes its rows, its starting value and its gradients from
    the other folds alone (cuts between bins come from all rows, without their
    labels). Folds without rows, or whose others have none, are left out.
    """
    if "fold" not in df.columns:
        raise ValueError("give each row a fold, such as season_folds does")
    scorer = scorer or ("rmse" if chosen.task == "regression" else "accuracy")
    rows = bo.frame_rows(df, "model", part=F.col("fold"))
    frames = {n: f for n, f in bo.frames_of(rows).items() if f.n >= least_rows}
    every = range(folds)
    specs = [
        bo.specified(frames, f"{n}/{k}", n, chosen, [p for p in every if p != k])
        for n, f in frames.items() for k in every if f.rows([k]) and f.rows(p for p in every if p != k)
    ]
    spark = df.sparkSession
    if not specs:
        return spark.createDataFrame([], "model string, fold int, fitted long, n long, score double")
    stored = bo.binned(rows, frames)
    models = bo.Models({s.name: s for s in specs}, frames, bo.grow(stored, specs, frames, local_rows=local_rows))
    own_fold = {s.name: int(s.name.rpartition("/")[2]) for s in specs}
    judged = models.scores(stored, ["label", "part"], "label double, part int", own_fold).withColumns(
        {"fold": F.substring_index("model", "/", -1).cast("int"),
         "model": F.expr("left(model, length(model) - length(substring_index(model, '/', -1)) - 1)")}
    )
    fitted = spark.createDataFrame(
        [(s.frame, own_fold[s.name], frames[s.frame].rows(s.parts)) for s in specs],
        "model string, fold int, fitted long",
    )
    return scores(judged, scorer, ["model", "fold"]).join(F.broadcast(fitted), ["model", "fold"]).select(
        "model", "fold", "fitted", "n", "score"
    )


def cross_validated(by_fold: DataFrame) -> DataFrame:
    """(model, folds, mean_score, std_score) of ``fold_scores``; the deviation is that of the folds themselves."""
    return by_fold.groupBy("model").agg(
        F.count("*").cast("int").alias("folds"), F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score")
    )
