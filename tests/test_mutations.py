"""Updates and deletes of stored tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from weekfold.operators import mutations as mt

SCHEMA = "id long, team string, season int, v double"


@pytest.fixture()
def stored(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "A B" if i % 2 else "C/D", 2020 + i % 3, float(i)) for i in range(30)] + [(100, None, None, 5.0), (101, "A B", 2020, None)]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("season", "team").parquet(path)
    return path, rows


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def read(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("id", "team", "season", "v").collect()), key=repr)


def test_update_writes_the_partitions_of_its_keys_alone(spark, stored):
    path, rows = stored
    before = files(path)
    changes = spark.createDataFrame([(3, 300.0, "x"), (9, None, "x"), (100, 7.0, "x"), (999, 1.0, "x")], "id long, v double, extra string")
    # ids 3 and 9 are in season 2020, team A B; 100 in the partition of nulls
    assert mt.update_stored(spark, path, changes, ["id"], ["v"], ["season", "team"], SCHEMA) == (2, 3)
    want = [(i, t, s, {3: 300.0, 100: 7.0}.get(i, v)) for i, t, s, v in rows]
    assert read(spark, path) == sorted(want, key=repr)
    after = files(path)
    kept = [f for f in before if after.get(f) == before[f]]
    assert {os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in kept} == {
        os.path.dirname(f) for f in before if "season=2020/team=A B" in f.replace("%20", " ") or "season=__HIVE" in f}
    assert mt.update_stored(spark, path, changes.where("id = 999"), ["id"], ["v"], ["season", "team"], SCHEMA) == (0, 0)
    assert files(path) == after


def test_update_refuses_what_is_not_clear(spark, stored):
    path, _ = stored
    twice = spark.createDataFrame([(3, 1.0), (3, 2.0)], "id long, v double")
    with pytest.raises(ValueError, match="unique"):
        mt.update_stored(spark, path, twice, ["id"], ["v"], ["season", "team"], SCHEMA)
    with pytest.raises(ValueError, match="season"):
        mt.update_stored(spark, path, twice.withColumn("season", F.lit(1)), ["id"], ["season"], ["season", "team"], SCHEMA)


def test_delete_empties_partitions_and_leaves_others(spark, stored):
    path, rows = stored
    before = files(path)
    condition = (F.col("season") == 2021) & (F.col("team") == "C/D") | (F.col("id") == 3) | F.col("season").isNull()
    assert mt.delete_stored(spark, path, condition, ["season", "team"], SCHEMA) == (3, 7)
    want = [r for r in rows if not ((r[2], r[1]) == (2021, "C/D") or r[0] == 3 or r[2] is None)]
    assert read(spark, path) == sorted(want, key=repr)
    left = {os.path.dirname(f) for f in files(path)}
    gone = {os.path.dirname(f) for f in before} - left
    assert len(gone) == 2 and any("season=__HIVE" in g for g in gone)
    untouched = [f for f, t in before.items() if files(path).get(f) == t]
    assert len(untouched) == len([f for f in before if "season=2022" in f or ("season=2021" in f and "A" in f.split("team=")[1][:1]) or ("season=2020" in f and "C" in f.split("team=")[1][:1])])
    # unknown is not true: the row without v stays
    assert mt.delete_stored(spark, path, F.col("v") > 1e9, ["season", "team"], SCHEMA) == (0, 0)


def test_tables_without_partitions(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.createDataFrame([(1, "a", 1, 1.0), (2, "b", 2, None)], SCHEMA).write.parquet(path)
    changes = spark.createDataFrame([(1, 9.0)], "id long, v double")
    assert mt.update_stored(spark, path, changes, ["id"], ["v"]) == (1, 1)
    assert mt.delete_stored(spark, path, F.col("v") > 100) == (0, 0)
    assert mt.delete_stored(spark, path, F.col("id") == 2) == (1, 1)
    assert read(spark, path) == [(1, "a", 1, 9.0)]
