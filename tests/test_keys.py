"""Stored key hashes: what is shuffled, and what survives an interrupted load."""

import re

import pytest
from pyspark.sql import functions as F

from weekfold.operators import ingest as ing
from weekfold.operators import keys
from weekfold.streaming import incremental as stream


def batch(spark, low, high):
    return spark.range(low, high).select(
        F.col("id").alias("key"), (F.col("id") % 3).cast("int").alias("season"), F.lit("v").alias("value")
    )


def load(spark, tmp_path, low, high):
    table, counts = ing.incremental_append(
        batch(spark, low, high), str(tmp_path / "rows"), "t", ["key"], ["season"], keys_path=str(tmp_path / "keys")
    )
    return table, counts.first()


def test_loads_store_each_key_once(spark, tmp_path):
    _, first = load(spark, tmp_path, 0, 50)
    _, again = load(spark, tmp_path, 30, 80)
    table, third = load(spark, tmp_path, 0, 80)
    assert (first.new_rows, again.new_rows, again.skipped_rows, third.new_rows) == (50, 30, 20, 0)
    assert table.count() == table.select("row_hash").distinct().count() == 80
    assert keys.KeyTable(spark, str(tmp_path / "keys")).hashes().count() == 80


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    known = keys.KeyTable(spark, str(tmp_path / "keys"), buckets=4)
    known.add(ing.with_key_hash(batch(spark, 0, 40), ["key"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hashed = ing.with_key_hash(batch(spark, 20, 60), ["key"])
        unseen = known.unseen(hashed)
        plan = unseen._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        # nothing is exchanged between the join and the scan of the keys
        stored = plan[plan.rindex("+- Sort"):] if "+- Sort" in plan else plan
        assert re.search(r"Bucketed: true|SelectedBucketsCount", stored) and "Exchange" not in stored
        assert sorted(r["key"] for r in unseen.collect()) == list(range(40, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_found_again_by_another_session(spark, tmp_path):
    path = str(tmp_path / "keys")
    known = keys.KeyTable(spark, path, buckets=4)
    known.add(ing.with_key_hash(batch(spark, 0, 10), ["key"]))
    spark.sql(f"DROP TABLE {known.name}")  # the catalog of a session ends with it
    again = keys.KeyTable(spark, path, buckets=999)
    assert again.buckets == 4 and again.hashes().count() == 10


def test_a_load_that_ended_between_rows_and_keys(spark, tmp_path, monkeypatch):
    load(spark, tmp_path, 0, 20)

    def lost(self, hashed):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(keys.KeyTable, "add", lost)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path, 10, 30)
    # the rows of the load that failed are there, their keys are not
    table, counts = load(spark, tmp_path, 15, 40)
    assert counts.new_rows == 10 and table.count() == 40
    assert not keys.KeyTable(spark, str(tmp_path / "keys")).interrupted()


def test_keys_of_a_table_that_had_none(spark, tmp_path):
    ing.incremental_append(batch(spark, 0, 20), str(tmp_path / "rows"), "t", ["key"], ["season"])
    table, counts = load(spark, tmp_path, 10, 30)
    assert counts.new_rows == 10 and table.count() == 30


def test_null_hashes_and_empty_batches(spark, tmp_path):
    known = keys.KeyTable(spark, str(tmp_path / "keys"), buckets=2)
    known.add(spark.createDataFrame([(None,), ("a",), ("a",)], "row_hash string"))
    assert [r.row_hash for r in known.hashes().collect()] == ["a"]
    _, counts = load(spark, tmp_path, 5, 5)
    assert counts.total_rows == counts.new_rows == 0


# --- keys as the state of a stream ------------------------------------------------------
def run(spark, tmp_path, **options):
    schema = batch(spark, 0, 1).withColumn("day", F.to_date(F.lit("2024-01-01"))).schema
    stream.keyed_stream(
        spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), ["key"], str(tmp_path / "state"), **options
    ).awaitTermination()
    return sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "out")).collect())


def arrive(spark, tmp_path, low, high, day="2024-01-01"):
    batch(spark, low, high).withColumn("day", F.to_date(F.lit(day))).write.mode("append").parquet(str(tmp_path / "in"))


def test_late_and_repeated_files_over_three_runs(spark, tmp_path):
    arrive(spark, tmp_path, 5, 15)
    assert run(spark, tmp_path) == list(range(5, 15))
    arrive(spark, tmp_path, 0, 10)  # late keys and repeated ones
    assert run(spark, tmp_path) == list(range(15))
    arrive(spark, tmp_path, 0, 20)
    assert run(spark, tmp_path) == list(range(20))
    assert run(spark, tmp_path) == list(range(20))  # nothing waits


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    options = {"event_time": "day", "expiry": "30 days"}
    arrive(spark, tmp_path, 0, 5)
    assert run(spark, tmp_path, **options) == list(range(5))
    arrive(spark, tmp_path, 0, 6, "2024-01-10")  # within their time: still known
    assert run(spark, tmp_path, **options) == list(range(6))
    arrive(spark, tmp_path, 90, 92, "2025-01-01")
    run(spark, tmp_path, **options)
    arrive(spark, tmp_path, 3, 4, "2023-01-01")  # later than the watermark allows
    assert run(spark, tmp_path, **options) == [*range(6), 90, 91]


def test_two_runs_at_a_time_store_each_key_once(spark, tmp_path):
    for low in range(0, 40, 4):
        arrive(spark, tmp_path, low, low + 6)
    schema = batch(spark, 0, 1).withColumn("day", F.to_date(F.lit("2024-01-01"))).schema
    begun = []
    for _ in range(2):
        try:
            begun.append(stream.keyed_stream(
                spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), ["key"], str(tmp_path / "state"), max_files=1
            ))
        except Exception as refused:  # the same checkpoint twice
            assert "concurrent" in str(refused).lower() or "already active" in str(refused).lower()
    for q in begun:
        try:
            q.awaitTermination()
        except Exception as ended:  # Spark ends one of two runs
            assert "concurrent" in str(ended).lower() or "active" in str(ended).lower()
    assert run(spark, tmp_path) == list(range(42))
