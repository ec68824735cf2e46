"""Continuous idempotent loading: new files in, unseen keys appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekfold.operators.ingest import new_rows, stored_near, with_key_hash
from weekfold.sources.sinks import path_exists


def append_unseen(batch: DataFrame, path: str, keys, partition_by=()) -> None:
    """Append the batch's rows whose key hash is not in the table yet.

    With ``partition_by`` columns that are part of the key, each batch searches
    only the partitions it touches, so its cost does not grow with the table.
    """
    spark = batch.sparkSession
    hashed = with_key_hash(batch, keys)
    if path_exists(spark, path):
        stored = spark.read.schema(hashed.schema).parquet(path)
        near = stored_near(hashed, stored, [c for c in partition_by if c in keys], keys)
        hashed = new_rows(hashed, near).select(*hashed.columns)
    hashed.write.mode("append").partitionBy(*partition_by).parquet(path)


def incremental_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    keys,
    checkpoint: str,
    max_files: int = 1000,
    transform=None,
    partition_by=(),
):
    """Drain the files waiting at ``source`` into ``target`` and stop.

    ``availableNow`` with a checkpoint makes each run pick up where the last
    one ended. A batch that is replayed after a failure finds its keys already
    stored and adds nothing, so the append is effectively once per key.
    """
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    )
    if transform is not None:
        stream = transform(stream)
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: append_unseen(batch, target, keys, partition_by))
        .start()
    )


def keyed_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    keys,
    checkpoint: str,
    max_files: int = 1000,
    event_time: str | None = None,
    expiry: str = "730 days",
    partition_by=(),
):
    """``incremental_stream`` with the keys as state of the stream: the target is never read.

    The state store of the checkpoint holds every key that was loaded, so a
    batch costs what it brings, and a restart goes on from it; rows and state
    are committed together. With ``event_time`` (a timestamp or date column) a
    key is kept for ``expiry`` after its time and then forgotten, which bounds
    the state; rows that come later than that are dropped as too late. Set the
    RocksDB provider for states beyond an executor's memory. A checkpoint has
    one run at a time: Spark refuses a second one, and its files wait.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    hashed = with_key_hash(stream, keys)
    if event_time is None:
        unseen = hashed.dropDuplicates(["row_hash"])
    else:
        timed = hashed.withColumn("_time", F.col(event_time).cast("timestamp")).withWatermark("_time", expiry)
        unseen = timed.dropDuplicatesWithinWatermark(["row_hash"]).drop("_time")
    return (
        unseen.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).option("path", target).partitionBy(*partition_by).start()
    )


def stored_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("row_hash", T.StringType())])
    return spark.read.schema(full).parquet(target)


def load_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("row_hash").alias("unique_hashes")
    )
