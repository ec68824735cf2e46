"""Writing tables by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the column order and types of ``schema``, matched by name.

    Columns the schema does not know are dropped, columns the frame lacks are
    null; having none in common is an error.
    """
    have = set(df.columns)
    if not any(f.name in have for f in schema):
        raise ValueError("no column in common with the target table")
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def append_aligned(target: DataFrame, df: DataFrame) -> DataFrame:
    """Rows of both frames in the target's layout."""
    return target.unionByName(align(df, target.schema))


def write_aligned(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "append",
    partition_by=(),
    only_present: bool = False,
) -> None:
    """Write by column name. ``mode`` is ``append``, ``replace`` or ``fail``.

    ``replace`` empties the table first; with ``only_present`` just the
    partitions that ``df`` has rows for are replaced and the others stay.
    ``fail`` refuses to touch a table that already holds rows.
    """
    spark = df.sparkSession
    out = align(df, schema) if schema is not None else df
    if mode == "fail":
        if path_exists(spark, path) and not spark.read.schema(out.schema).parquet(path).isEmpty():
            raise ValueError(f"{path} already holds rows")
        mode = "append"
    writer = out.write.mode({"append": "append", "replace": "overwrite"}[mode])
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if only_present else "static"
        )
    writer.parquet(path)


def refresh(df: DataFrame, path: str, partition_by=("season",)) -> DataFrame:
    """Rebuild a stage table and read it back, so later stages start from files.

    Rows are brought together by partition first, and Spark splits the large
    ones: few files for each, instead of one for each task and partition.
    """
    cols = [c for c in partition_by if c in df.columns]
    write_aligned(df.hint("rebalance", *cols) if cols else df, path, mode="replace", partition_by=cols)
    # partition columns come back last; keep the caller's order
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
