"""Top-k, best-per-key and set difference."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, score, n: int, tiebreak=()) -> DataFrame:
    """The ``n`` highest rows; each task keeps n rows, so nothing is sorted whole."""
    return df.orderBy(*[F.desc(c) for c in score], *tiebreak).limit(n)


def top_per_key(df: DataFrame, keys, newest, n: int, rank: str = "rank") -> DataFrame:
    """The ``n`` rows with the largest ``newest`` per key.

    The rank filter sits directly on the window, so Spark trims every group to
    n rows before the shuffle (window group limit) and a dominant key shrinks
    to n rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def best_per_key(df: DataFrame, keys, by, keep, highest: bool = True) -> DataFrame:
    """One row per key, the one largest (or smallest) on ``by``.

    An aggregate rather than a window: it combines on the map side and needs no
    sort, however many rows a key has.
    """
    pick = F.max_by if highest else F.min_by
    best = pick(F.struct(*keep), F.struct(*by))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def missing_keys(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks."""
    return df.select(*keys).distinct().join(other.select(*keys).distinct(), list(keys), "left_anti")
