"""Idempotent loading by key hash."""

from __future__ import annotations

import time
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weekfold import config
from weekfold.functions.nested import spaced_json
from weekfold.functions.scalars import existing
from weekfold.operators.keys import key_table
from weekfold.session import settle
from weekfold.sources.sinks import path_exists, write_aligned


def key_columns(df: DataFrame, table: str | None = None, keys=None, partial: bool = False) -> list[str]:
    """Identity columns of a table: ``keys``, or those configured for it.

    A key column that the frame lacks is an error, since rows that differ only
    in it would be taken for the same. With ``partial`` the caller accepts what
    is there, or else the first three columns.
    """
    wanted = list(keys or config.KEY_COLUMNS.get(table, config.DEFAULT_KEY))
    have = existing(df, wanted)
    if partial:
        return have or df.columns[:3]
    missing = set(wanted) - set(have) - set(config.OPTIONAL_KEY_COLUMNS.get(table, ()))
    if missing or not have:
        raise ValueError(f"key columns {sorted(missing or wanted)} of {table} are missing")
    return have


def with_key_hash(df: DataFrame, keys) -> DataFrame:
    """``row_hash``: md5 of the JSON text of the non-null key columns."""
    return df.withColumn("row_hash", F.md5(spaced_json(list(keys))))


def fingerprint(df: DataFrame) -> DataFrame:
    """One-row batch fingerprint of shape and column names (not of the content)."""
    width = len(df.columns)
    names = "[" + ", ".join(f"'{c}'" for c in df.columns) + "]"
    n = F.count(F.lit(1))
    text = F.concat(
        F.lit("("), n.cast("string"), F.lit(f", {width})"), F.lit(names), (n * width).cast("string")
    )
    return df.agg(F.substring(F.sha2(text, 256), 1, 16).alias("batch_hash"), n.alias("rows"))


def known_hashes(target: DataFrame) -> DataFrame:
    return target.select("row_hash").filter(F.col("row_hash").isNotNull()).distinct()


def content_fingerprint(df: DataFrame, columns=None) -> DataFrame:
    """One-row batch fingerprint of the content: equal for equal rows in any order.

    Every row's JSON text is hashed and the hashes are summed, so it takes one
    pass and no sort; repeated rows count as often as they occur.
    """
    digest = F.conv(F.substring(F.md5(spaced_json(list(columns or df.columns))), 1, 12), 16, 10)
    n, total = F.count(F.lit(1)), F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0))
    text = F.concat(n.cast("string"), F.lit(":"), total.cast("decimal(38,0)").cast("string"))
    return df.agg(F.substring(F.sha2(text, 256), 1, 16).alias("content_hash"), n.alias("rows"))


def hash_tree(df: DataFrame, by, key: str, buckets: int = 256, columns=None) -> DataFrame:
    """(``by``, bucket, n, total): counts and sums of row hashes, the leaves of a tree over partitions and key buckets.

    The hash of a row covers all its columns (or ``columns``). Sums of leaves
    are those of partitions and of the table, so two trees can be compared from
    the top. Keep it with each load: it has at most ``buckets`` rows a partition.
    """
    digest = F.conv(F.substring(F.md5(spaced_json(list(columns or df.columns))), 1, 12), 16, 10).cast("decimal(38,0)")
    bucket = F.pmod(F.xxhash64(key) if dict(df.dtypes)[key] not in ("bigint", "int") else F.col(key), F.lit(buckets))
    return df.groupBy(*by, bucket.cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(digest).alias("total")
    )


def changed_parts(old: DataFrame, new: DataFrame, by) -> DataFrame:
    """(``by``, bucket, old_rows, new_rows) of the leaves of two ``hash_tree`` tables that differ.

    Partitions are compared first, and buckets only within those that differ;
    trees stored by partition are read there alone. Null partition values match.
    """
    def differing(names, a: DataFrame, b: DataFrame) -> DataFrame:
        def side(df: DataFrame, prefix: str) -> DataFrame:
            return df.groupBy(*names).agg(F.sum("n").alias(f"{prefix}n"), F.sum("total").alias(f"{prefix}total")).select(
                *[F.col(c).alias(f"{prefix}{c}") for c in names], f"{prefix}n", f"{prefix}total"
            )

        left, right = side(a, "a_"), side(b, "b_")
        same = reduce(and_, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in names])
        met = left.join(right, same, "full_outer")
        equal = F.col("a_n").eqNullSafe(F.col("b_n")) & F.col("a_total").eqNullSafe(F.col("b_total"))
        return met.where(~equal).select(
            *[F.when(F.col("a_n").isNotNull(), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c) for c in names],
            F.coalesce("a_n", F.lit(0)).alias("old_rows"), F.coalesce("b_n", F.lit(0)).alias("new_rows"),
        )

    by = list(by)
    parts = settle(differing(by, old, new), "changed-partitions").select(*[F.col(c).alias(f"_{c}") for c in by])
    inside = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return differing([*by, "bucket"], *[t.join(parts, inside, "left_semi") for t in (old, new)])


def stored_near(batch: DataFrame, stored: DataFrame, scope, keys) -> DataFrame:
    """The stored rows that can share a key with the batch, and perhaps some more.

    ``scope`` names partition columns that belong to the key. The semi join
    with their values in the batch prunes partitions at run time; rows with a
    null in the scope, a partition of their own, stay in play.
    """
    outside = set(scope) - set(keys)
    if outside:
        raise ValueError(f"{sorted(outside)} is no part of the key: its values cannot tell where a key is stored")
    scope = [c for c in scope if c in batch.columns]
    if not scope:
        return stored
    open_scope = reduce(or_, (F.col(c).isNull() for c in scope))
    values = batch.select(*scope).distinct()
    return stored.join(values, scope, "left_semi").unionByName(stored.filter(open_scope))


def new_rows(hashed: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose hash the target does not hold yet; copies inside a batch all stay."""
    return hashed.join(known_hashes(target), "row_hash", "left_anti")


def split_batch(hashed: DataFrame, target: DataFrame | None) -> DataFrame:
    """The batch with an ``is_new`` flag, from one left join."""
    if target is None:
        return hashed.withColumn("is_new", F.lit(True))
    known = known_hashes(target).withColumn("_known", F.lit(True))
    return hashed.join(known, "row_hash", "left").withColumn(
        "is_new", F.col("_known").isNull()
    ).drop("_known")


def counters(flagged: DataFrame, table: str, seconds: float | None = None) -> DataFrame:
    """total / new / updated / skipped rows and efficiency of one load, and how long it took."""
    total = F.count(F.lit(1))
    new = F.count_if("is_new")
    return flagged.agg(
        total.alias("total_rows"),
        new.alias("new_rows"),
        F.lit(0).cast("bigint").alias("updated_rows"),
        (total - new).alias("skipped_rows"),
        F.when(total > 0, new * 100.0 / total).otherwise(F.lit(0.0)).alias("efficiency"),
    ).withColumns({
        "table_name": F.lit(table), "seconds": F.lit(seconds).cast("double"),
    })


def run_summary(loads: DataFrame) -> DataFrame:
    """Totals over several loads (rows of ``counters``)."""
    total, new = F.sum("total_rows"), F.sum("new_rows")
    updated, seconds = F.sum("updated_rows"), F.sum("seconds")
    return loads.agg(
        F.count(F.lit(1)).alias("total_operations"),
        total.alias("total_rows_processed"),
        new.alias("total_new_rows"),
        updated.alias("total_updated_rows"),
        F.sum("skipped_rows").alias("total_skipped_rows"),
        F.when(total > 0, (new + updated) * 100.0 / total).otherwise(F.lit(0.0)).alias("overall_efficiency"),
        seconds.alias("total_seconds"),
        F.when(seconds > 0, F.count(F.lit(1)) / seconds).alias("operations_per_second"),
    )


def hash_coverage(df: DataFrame) -> DataFrame:
    """Distinct hashes against rows; two-level, so a repeated hash is combined early."""
    per_hash = df.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n"))
    rows, hashes = F.sum("n"), F.count("row_hash")
    return per_hash.agg(
        rows.alias("total_rows"),
        hashes.alias("unique_hashes"),
        F.when(rows > 0, hashes * 100.0 / rows).otherwise(F.lit(0.0)).alias("hash_coverage"),
    )


def incremental_append(
    df: DataFrame, path: str, table: str, keys=None, partition_by=(), scope=None, keys_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Append the rows of ``df`` that ``path`` does not hold, and count what happened.

    ``scope`` names partition columns that are part of the key, so only the
    partitions a batch touches are searched (``stored_near``); by default all
    partition columns that are. The batch is read once: its rows and the new
    ones among them are counted while they are written. With ``keys_path`` the
    key hashes are kept there, bucketed (``keys.KeyTable``): then only the batch
    is shuffled, whatever its keys. Returns (the table, one counters row).
    """
    spark, begun = df.sparkSession, time.perf_counter()
    keys = key_columns(df, table, keys)
    scope = [c for c in partition_by if c in keys] if scope is None else scope
    hashed = with_key_hash(df, keys)
    read, written = Observation(), Observation()
    batch = hashed.observe(read, F.count(F.lit(1)).alias("rows"))
    # dropping the stale listing first makes repeated loads see earlier files
    stored = spark.read.schema(hashed.schema).parquet(path) if path_exists(spark, path) else None
    known = key_table(spark, keys_path, stored) if keys_path else None
    if known is not None:
        flagged = known.flagged(batch)
    elif stored is not None:
        flagged = split_batch(batch, stored_near(hashed, stored, scope, keys))
    else:
        flagged = split_batch(batch, None)
    fresh = flagged.filter("is_new").select(*hashed.columns)
    if known is not None:
        # written once: rows and keys must come from the same batch
        fresh = settle(fresh, "fresh-rows")
        mark = known.begin()
    fresh = fresh.observe(written, F.count(F.lit(1)).alias("rows"))
    write_aligned(fresh, path, hashed.schema, "append", partition_by)
    if known is not None:
        known.add(fresh)
        known.end(mark)
    total, added = read.get.get("rows", 0), written.get.get("rows", 0)
    counted = spark.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(total).cast("bigint").alias("total_rows"),
        F.lit(added).cast("bigint").alias("new_rows"),
        F.lit(0).cast("bigint").alias("updated_rows"),
        F.lit(total - added).cast("bigint").alias("skipped_rows"),
        F.lit(100.0 * added / total if total else 0.0).alias("efficiency"),
        F.lit(time.perf_counter() - begun).alias("seconds"),
    )
    return spark.read.schema(hashed.schema).parquet(path), counted
