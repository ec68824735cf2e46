"""The model table: versions, latest, best, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold.functions.nested import widen_metrics
from weekfold.operators.setops import best_per_key


def primary_metric(metrics: str = "metrics", model_type: str = "model_type") -> Column:
    """rmse (else mse) for regression, f1 (else accuracy) for classification, else 0."""
    doc = F.from_json(F.col(metrics), "map<string,double>")

    def pick(*names):
        return F.coalesce(*[F.element_at(doc, F.lit(n)) for n in names], F.lit(0.0))

    return (
        F.when(F.col(model_type) == "regression", pick("rmse", "mse"))
        .when(F.col(model_type) == "classification", pick("f1", "accuracy"))
        .otherwise(F.lit(0.0))
    )


def latest_per_key(models: DataFrame, keep, key: str = "model_name", by=("created_at", "model_id")) -> DataFrame:
    return best_per_key(models, [key], list(by), keep)


def best_per_metric(
    models: DataFrame, keep, metric: str = "primary_metric", higher_is_better: bool = True,
    key: str = "model_name", tiebreak: str = "model_id",
) -> DataFrame:
    """Best active model per name by a metric; models without it cannot win."""
    active = models.filter((F.col("status") == "active") & F.col(metric).isNotNull())
    return best_per_key(active, [key], [metric, tiebreak], keep, highest=higher_is_better)


def bump_patch(version: Column, by: Column | int = 1) -> Column:
    """``major.minor.patch`` with patch + 1 (or more); null stays null."""
    parts = [F.split_part(version, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3)]
    return F.concat(
        parts[0].cast("string"), F.lit("."), parts[1].cast("string"), F.lit("."),
        (parts[2] + by).cast("string"),
    )


def next_version(models: DataFrame, names: DataFrame, key: str = "model_name") -> DataFrame:
    """Next version of each name: 1.0.0 when new, else the latest with patch + 1."""
    latest = latest_per_key(models, ["version"], key)
    return names.join(latest, key, "left").select(
        key, F.coalesce(bump_patch(F.col("version")), F.lit("1.0.0")).alias("version")
    )


def append_versions(models: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append for ``new`` models: versioned, with their primary metric.

    Several new rows of one name get versions one after the other, in the order
    of ``created_at`` and ``model_id``. Columns of the model table that the new
    rows lack are null.
    """
    versions = next_version(models, new.select("model_name").distinct())
    turn = F.row_number().over(Window.partitionBy("model_name").orderBy("created_at", "model_id")) - 1
    rows = new.drop("version", "primary_metric").join(versions, "model_name").withColumn("_turn", turn).withColumns({
        "version": bump_patch(F.col("version"), F.col("_turn")), "primary_metric": primary_metric(),
    })
    return rows.select(*[
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in models.schema
    ])


def list_models(models: DataFrame, limit: int = 100, status: str | None = "active", **filters) -> DataFrame:
    for name, value in {"status": status, **filters}.items():
        if value is not None:
            models = models.filter(F.col(name) == value)
    return models.orderBy(F.desc("created_at"), F.desc("model_id")).limit(limit)


def compare(models: DataFrame, model_ids, metrics: list[str] | None = None) -> DataFrame:
    """The chosen models with their metrics spread into columns."""
    chosen = models.filter(F.col("model_id").isin(list(model_ids)))
    return widen_metrics(
        chosen.select("model_id", "model_name", "version", "model_type", "metrics", "primary_metric"),
        "metrics", metrics,
    ).drop("metrics")
