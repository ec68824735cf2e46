"""Reading the given tables and small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekfold.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, under fixed names, so that no other column can clash."""
    return docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
