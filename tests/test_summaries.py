"""Mergeable summaries, and the files of a rebuilt table."""

import glob

import pytest
from pyspark.sql import functions as F

from weekfold.operators import quality, summaries
from weekfold.sources import sinks


def test_summaries_of_loads_equal_those_of_all_rows(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7000).alias("k"), (F.col("id") % 5).cast("int").alias("part"),
        F.when(F.col("id") % 4 > 0, F.sqrt("id")).alias("x"), F.concat(F.lit("n"), F.col("id") % 11).alias("name"),
    )
    columns = ["k", "x", "name"]
    loads = [summaries.summarise(df.where(f"k % 3 = {i}"), columns, ["part"], f"load-{i}") for i in range(3)]
    stored = loads[0].unionByName(loads[1]).unionByName(loads[2])
    assert stored.count() == 3 * 5 * 3
    got = {r.column: r for r in summaries.unite(stored).withColumn("median", summaries.quantile("quantile_sketch", 0.5)).collect()}
    assert all(r.n == 20_000 for r in got.values())
    assert got["x"].nulls == 5000 and got["k"].low_number == 0 and got["k"].high_number == 6999
    assert got["name"].low_text == "n0" and got["name"].distinct == 11 and got["name"].median is None
    assert abs(got["k"].distinct - 7000) < 0.03 * 7000
    share = df.where("x is not null").agg(F.avg((F.col("x") <= got["x"].median).cast("int"))).first()[0]
    assert abs(share - 0.5) < 0.03
    by_part = summaries.unite(stored, ["part"]).where("column = 'k'").collect()
    assert sorted(r.part for r in by_part) == [0, 1, 2, 3, 4] and sum(r.n for r in by_part) == 20_000


def test_columns_of_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    got = {r.column: r for r in summaries.unite(summaries.summarise(df, ["x", "s"])).withColumn(
        "median", summaries.quantile("quantile_sketch", 0.5)).collect()}
    assert got["x"].nulls == got["s"].nulls == 2 and got["x"].median is None and got["x"].distinct == 0
    assert summaries.unite(summaries.summarise(df.limit(0), ["x"])).count() == 0


def test_distinct_estimates(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    for r in quality.distinct_per_group(df, ["g"], "id", within=0.02).collect():
        assert r.id == pytest.approx(2500, rel=0.1)


def test_a_rebuilt_table_has_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 4).cast("int").alias("season"))
    out = sinks.refresh(df, str(tmp_path / "t"))
    assert out.columns == ["id", "season"] and out.count() == 4000
    assert len(glob.glob(f"{tmp_path}/t/season=*/*.parquet")) <= 8  # not tasks times seasons
