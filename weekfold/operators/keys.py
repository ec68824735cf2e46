"""Stored key hashes that do not move: a table bucketed by hash beside the raw table."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekfold.sources.sinks import path_exists

BUCKETS = 64


class KeyTable:
    """The distinct key hashes of a table, in buckets of the hash.

    A batch is dealt out by hash into as many partitions and meets each bucket
    where it lies: looking for unseen keys shuffles the batch, never the stored
    keys. The number of buckets is fixed when the table is made and is part of
    its path, so every later session finds it.

    One loader at a time. ``loading`` leaves a mark before rows are written and
    takes it away when their keys are; a mark that is found says that a load
    ended in between, and the keys are completed from the rows.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._stored_buckets() or buckets
        self.location = f"{self.path}/buckets-{self.buckets}"
        self.name = "keys_" + hashlib.md5(self.location.encode()).hexdigest()
        if not spark.catalog.tableExists(self.name):
            spark.sql(
                f"CREATE TABLE {self.name} (row_hash STRING) USING parquet CLUSTERED BY (row_hash) "
                f"SORTED BY (row_hash) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
            )

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _stored_buckets(self) -> int | None:
        if not path_exists(self.spark, self.path):
            return None
        fs, hadoop = self._fs(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
        return next((int(n.removeprefix("buckets-")) for n in names if n.startswith("buckets-")), None)

    def hashes(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, hashed: DataFrame) -> DataFrame:
        """Rows whose hash is not stored; copies inside a batch all stay."""
        return hashed.join(self.hashes(), "row_hash", "left_anti")

    def flagged(self, hashed: DataFrame) -> DataFrame:
        """The batch with an ``is_new`` flag."""
        known = self.hashes().withColumn("_known", F.lit(True))
        return hashed.join(known, "row_hash", "left").withColumn("is_new", F.col("_known").isNull()).drop("_known")

    def add(self, hashed: DataFrame) -> None:
        """Store the distinct hashes of rows that were unseen: one file for each bucket."""
        fresh = hashed.select("row_hash").where("row_hash is not null").distinct()
        fresh.repartition(self.buckets, "row_hash").write.insertInto(self.name)

    def complete(self, rows: DataFrame) -> None:
        """Store what the table's rows have and the keys lack."""
        self.add(self.unseen(rows.select("row_hash")))

    def interrupted(self) -> bool:
        fs, hadoop = self._fs(f"{self.path}/loading")
        return fs.exists(hadoop) and len(fs.listStatus(hadoop)) > 0

    def begin(self) -> str:
        mark = f"{self.path}/loading/{uuid.uuid4().hex}"
        fs, hadoop = self._fs(mark)
        fs.create(hadoop).close()
        return mark

    def end(self, mark: str | None = None) -> None:
        """Take one mark away, or all after ``complete``."""
        fs, hadoop = self._fs(mark or f"{self.path}/loading")
        fs.delete(hadoop, True)


def key_table(spark: SparkSession, path: str, rows: DataFrame | None, buckets: int = BUCKETS) -> KeyTable:
    """The key table at ``path``, completed from ``rows`` if it is new or a load was interrupted."""
    fresh = not path_exists(spark, path)
    table = KeyTable(spark, path, buckets)
    if rows is not None and (fresh or table.interrupted()):
        table.complete(rows)
        table.end()
    return table
