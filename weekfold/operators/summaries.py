"""Mergeable summaries: one small row for each load, partition and column, united on reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint")
#: log2 of the registers of a distinct-count sketch: about 0.8 % off at 14.
REGISTERS = 14
QUANTILE_SIZE = 400


def summarise(df: DataFrame, columns, by=(), load: str | None = None) -> DataFrame:
    """(load, ``by``, column, n, nulls, low, high, distinct_sketch, quantile_sketch).

    One pass and one small row for each group and column, whatever the rows.
    ``low`` and ``high`` are text; only numbers have quantile sketches. Rows of
    several loads lie in one table and are united by ``unite``.
    """
    by, kinds = list(by), dict(df.dtypes)
    entries = []
    for c in columns:
        value = F.col(f"`{c}`")
        number = kinds[c] in NUMBERS or kinds[c].startswith("decimal")
        entries.append(F.struct(
            F.lit(c).alias("column"), value.cast("string").alias("text"),
            (value.cast("double") if number else F.lit(None).cast("double")).alias("number"),
        ))
    long = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
    return long.groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("text").isNull()).alias("nulls"),
        F.min("text").alias("low_text"), F.max("text").alias("high_text"),
        F.min("number").alias("low_number"), F.max("number").alias("high_number"),
        F.hll_sketch_agg("text", F.lit(REGISTERS)).alias("distinct_sketch"),
        F.when(F.count("number") > 0, F.kll_sketch_agg_double("number", F.lit(QUANTILE_SIZE))).alias("quantile_sketch"),
    ).withColumn("load", F.lit(load))


def quantile(sketch: str, share: float) -> Column:
    """A quantile from a sketch; null where the column has no numbers."""
    return F.when(
        F.kll_sketch_get_n_double(F.col(sketch)) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(share)))
    )


def unite(summaries: DataFrame, by=()) -> DataFrame:
    """Summaries of all loads (and of all partitions not in ``by``) as one row for each group and column.

    ``distinct`` is an estimate; counts and extremes are exact.
    """
    return summaries.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.min("low_number").alias("low_number"), F.max("high_number").alias("high_number"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )
