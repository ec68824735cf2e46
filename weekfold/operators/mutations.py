"""Changing stored tables: only the partitions that hold affected rows are written anew."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekfold.operators.joins import delete_where, update_from
from weekfold.session import settle
from weekfold.sources.sinks import write_aligned


def _in_partitions(stored: DataFrame, partitions: DataFrame, by: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of the named partitions; the scan reads no others (null is a partition too)."""
    named = partitions.select(*[F.col(c).alias(f"_{c}") for c in by])
    return stored.join(named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]), how)


def _rewrite(rows: DataFrame, path: str, partition_by: list[str]) -> DataFrame:
    """Replace the partitions of ``rows`` by a copy that was written first, so nothing is read while it is replaced."""
    copy = settle(rows, "rewritten")
    write_aligned(copy, path, mode="replace", partition_by=partition_by, only_present=bool(partition_by))
    return copy


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def update_stored(
    spark: SparkSession, path: str, changes: DataFrame, on, columns, partition_by=(), schema=None
) -> tuple[int, int]:
    """Overwrite ``columns`` of the stored rows whose keys ``changes`` has; its nulls keep the old value.

    Returns the numbers of partitions written anew and of rows with changes.
    Keys must be unique in ``changes``, and neither keys nor partition columns
    can be changed. Keys that are not stored change nothing; null keys match
    nothing. Files of other partitions stay as they are. A run that was
    interrupted can be repeated.
    """
    on, by = list(on), list(partition_by)
    fixed = set(columns) & {*on, *by}
    if fixed:
        raise ValueError(f"{sorted(fixed)} place or name a row and cannot be changed")
    changes = settle(changes.select(*on, *columns), "changes")
    if not changes.dropna(subset=on).groupBy(*on).count().where("count > 1").isEmpty():
        raise ValueError(f"{on} is not unique in the changes")
    stored = _stored(spark, path, schema)
    hit = stored.select(*dict.fromkeys([*on, *by])).join(changes.select(*on), on, "left_semi")
    counted = settle(hit.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")), "affected")
    partitions, rows = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if not rows:
        return 0, 0
    affected = _in_partitions(stored, counted, by) if by else stored
    _rewrite(update_from(affected, changes, on, columns).select(*stored.columns), path, by)
    return partitions, rows


def delete_stored(spark: SparkSession, path: str, condition: Column, partition_by=(), schema=None) -> tuple[int, int]:
    """Delete the stored rows for which ``condition`` is true; false and unknown stay.

    Returns the numbers of partitions that lost rows and of rows deleted. A
    partition that loses all its rows loses its files; those of partitions
    without such rows stay as they are. A run that was interrupted can be
    repeated.
    """
    by = list(partition_by)
    stored = _stored(spark, path, schema)
    gone = stored.where(condition)
    counted = settle(gone.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")), "affected")
    partitions, rows = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if not rows:
        return 0, 0
    if not by:
        _rewrite(delete_where(stored, condition), path, by)
        return partitions, rows
    affected = _in_partitions(stored, counted, by)
    folder = F.regexp_replace(F.input_file_name(), "/[^/]*$", "")
    folders = settle(
        _in_partitions(stored.withColumn("_folder", folder), counted, by).select(*by, "_folder").distinct(), "folders"
    )
    kept = _rewrite(delete_where(affected, condition), path, by).select(*by).distinct()
    emptied = _in_partitions(folders, kept, by, "left_anti").select("_folder").distinct()
    jvm = spark.sparkContext._jvm
    for r in emptied.toLocalIterator():  # one small row for each partition without rows
        old = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_folder"]))
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return partitions, rows
