"""Temporal splits and leak checks."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekfold.functions.scalars import leaks_outcome, ordinal
from weekfold.operators.windows import number_events, period_rank

SPLITS = ("train", "validation", "test")


def temporal_split(df: DataFrame, train: float = 0.7, validation: float = 0.2) -> DataFrame:
    """Label rows by the rank of their period among all distinct periods.

    The first period of each later split is a scalar, so rows are labelled where
    they are, without a join. Rows without a period are dropped.
    """
    ranks, total = period_rank(df), F.col("total_periods")

    def first_after(share: float):
        return F.min(F.when(F.col("time_rank") > total * share, ordinal()))

    borders = ranks.agg(F.struct(
        first_after(train).alias("validation"), first_after(train + validation).alias("test")
    ).alias("borders"))
    label = (
        F.when(ordinal() >= F.col("_borders.test"), F.lit("test"))
        .when(ordinal() >= F.col("_borders.validation"), F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    return (
        df.drop("split").filter(ordinal().isNotNull())
        .withColumn("_borders", borders.scalar()).withColumn("split", label).drop("_borders")
    )


def ratio_split(
    df: DataFrame,
    ratios=(0.7, 0.2, 0.1),
    key: str = "feature_id",
) -> DataFrame:
    """Label rows by their position in time order: first 70 %, next 20 %, rest.

    Only per-period counts are accumulated; what follows from them, the last
    whole period of each split and the (at most two) periods a boundary falls
    into, is a scalar, so whole periods are labelled without a join or a
    shuffle. Rows are numbered only in those two periods, in the order of
    ``md5(key)`` and sliced by its first digits, so no task sorts a whole period.
    """
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError("ratios must sum to 1")
    counts = df.groupBy("season", "week").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()
    upto = Window.orderBy("season", "week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_n").over(everything)
    # as decimals: the nearest double of 84,240 * 0.7 lies below 58,968
    first, second = (F.floor(total * F.lit(Decimal(str(r)))).cast("long") for r in ratios[:2])
    end, cut1, cut2 = F.col("_end"), F.col("_cut1"), F.col("_cut2")
    periods = counts.filter(ordinal().isNotNull()).select(
        ordinal().alias("_at"), "_n", F.sum("_n").over(upto).alias("_end"),
        first.alias("_cut1"), (first + second).alias("_cut2"),
    )

    def divided(cut):
        """The period in which a boundary falls, and the rows before it."""
        inside = (end - F.col("_n") < cut) & (cut < end)
        return F.max(F.when(inside, F.struct(F.col("_at").alias("at"), (end - F.col("_n")).alias("before"))))

    found = periods.agg(F.struct(
        F.max(F.when(end <= cut1, F.col("_at"))).alias("train_to"),
        F.max(F.when(end <= cut2, F.col("_at"))).alias("validation_to"),
        divided(cut1).alias("first"), divided(cut2).alias("second"),
        F.max(cut1).alias("cut1"), F.max(cut2).alias("cut2"),
    ).alias("borders"))
    b = "_borders."
    placed = df.filter(ordinal().isNotNull()).withColumn("_borders", found.scalar())
    cut_here = F.coalesce(ordinal() == F.col(b + "first.at"), F.lit(False)) | F.coalesce(
        ordinal() == F.col(b + "second.at"), F.lit(False)
    )
    whole = placed.filter(~cut_here).withColumn(
        "split",
        F.when(ordinal() <= F.col(b + "train_to"), F.lit("train"))
        .when(ordinal() <= F.col(b + "validation_to"), F.lit("validation"))
        .otherwise(F.lit("test")),
    )
    cut = placed.filter(cut_here).withColumn("_md5", F.md5(F.col(key)))
    numbered = number_events(cut, ["season", "week"], ["_md5"], F.substring("_md5", 1, 4), "_nth")
    before = F.when(ordinal() == F.col(b + "first.at"), F.col(b + "first.before")).otherwise(F.col(b + "second.before"))
    at = before + F.col("_nth")
    inside = numbered.withColumn(
        "split",
        F.when(at <= F.col(b + "cut1"), F.lit("train"))
        .when(at <= F.col(b + "cut2"), F.lit("validation"))
        .otherwise(F.lit("test")),
    )
    return whole.select(*df.columns, "split").unionByName(inside.select(*df.columns, "split"))


def split_ranges(df: DataFrame) -> DataFrame:
    t = ordinal()
    return df.groupBy("split").agg(F.min(t).alias("earliest"), F.max(t).alias("latest"))


def target_completeness(df: DataFrame) -> DataFrame:
    total, found = F.count(F.lit(1)), F.count("outcomes")
    return df.groupBy("split").agg(
        total.alias("total_rows"), found.alias("rows_with_targets"),
        (found * 100.0 / total).alias("target_pct"),
    )


def leaking_names(df: DataFrame, names: str = "names") -> DataFrame:
    """Distinct feature names that mention an outcome."""
    # name lists repeat per row: distinct lists first, then their elements
    listed = df.select(names).distinct().select(F.explode(names).alias("feature_name")).distinct()
    return listed.filter(leaks_outcome("feature_name"))


def _check(df: DataFrame, name: str, violations, details) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"), (violations == 0).alias("passed"),
        violations.cast("bigint").alias("violations"), details.alias("details"),
    )


def leak_checks(df: DataFrame) -> DataFrame:
    """The validation log: one row per check, from aggregates only."""
    first = _check(
        df.agg(F.count_if(F.col("week") == 1).alias("v")), "week_1_features", F.col("v"),
        F.to_json(F.struct(F.col("v").alias("week_1_count"))),
    )
    leaked = _check(
        leaking_names(df).agg(F.count(F.lit(1)).alias("v"), F.sort_array(F.collect_set("feature_name")).alias("f")),
        "future_outcome_leakage", F.col("v"), F.to_json(F.struct(F.col("f").alias("suspicious_features"))),
    )
    spans = split_ranges(df).agg(*[
        F.max(F.when(F.col("split") == s, F.col(c))).alias(f"{s}_{c}")
        for s in SPLITS for c in ("earliest", "latest")
    ])

    def overlap(a, b):
        return F.coalesce((F.col(f"{a}_latest") >= F.col(f"{b}_earliest")).cast("int"), F.lit(0))

    ordered = _check(
        spans, "split_temporal_order",
        overlap("train", "validation") + overlap("validation", "test"),
        F.to_json(F.struct(*[f"{s}_{c}" for s in SPLITS for c in ("earliest", "latest")])),
    )
    short = F.col("split").isin("train", "validation") & (F.col("target_pct") < 100.0)
    complete = _check(
        target_completeness(df).agg(
            F.count_if(short).alias("v"),
            F.sort_array(F.collect_list(F.struct("split", "total_rows", "rows_with_targets"))).alias("s"),
        ),
        "data_completeness", F.col("v"), F.to_json(F.struct(F.col("s").alias("stats"))),
    )
    return reduce(DataFrame.unionByName, [first, leaked, ordered, complete])


def require_clean(log: DataFrame) -> DataFrame:
    """Raise if any check of the (four-row) log failed."""
    failed = [r.check_name for r in log.filter(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise ValueError(f"temporal validation failed: {failed}")
    return log
