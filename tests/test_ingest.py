"""Key hashes, idempotent loads, continuous loads."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekfold import config, schemas
from weekfold.operators import ingest as ing
from weekfold.streaming import incremental as stream


def batch(spark, data):
    return spark.createDataFrame(data, "player_id string, season int, week int, v double")


def test_hash_is_md5_of_sorted_json_without_nulls(spark):
    df = batch(spark, [("p\"1", 2023, 4, 1.0), (None, 2023, 5, 1.0)])
    got = [r.row_hash for r in ing.with_key_hash(df, ["week", "player_id", "season"]).orderBy("week").collect()]
    want = [
        hashlib.md5(json.dumps(d, sort_keys=True).encode()).hexdigest()
        for d in ({"player_id": "p\"1", "season": 2023, "week": 4}, {"season": 2023, "week": 5})
    ]
    assert got == want


def test_key_selection(spark):
    df = batch(spark, [])
    assert ing.key_columns(df, "unknown") == ["player_id", "season", "week"]
    full = df.withColumns({"season_type": F.lit("REG")})
    assert ing.key_columns(full, "raw_player_stats") == ["player_id", "season", "week", "season_type"]
    for frame, table in ((df, "raw_player_stats"), (df.select("v", "week"), "raw_combine")):
        with pytest.raises(ValueError):
            ing.key_columns(frame, table)
    assert ing.key_columns(df.select("v", "week"), "raw_combine", partial=True) == ["v", "week"]


@pytest.mark.parametrize("table", [t for t in config.KEY_COLUMNS if t in schemas.RAW])
def test_keys_exist_in_their_feed(table):
    optional = config.OPTIONAL_KEY_COLUMNS.get(table, [])
    assert set(config.KEY_COLUMNS[table]) <= {*schemas.RAW[table].fieldNames(), *optional}


def raw_rows(spark, table, rows):
    schema = schemas.RAW[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def test_depth_chart_of_a_second_week_is_loaded(spark, tmp_path):
    rows = [
        {"season": 2023, "club_code": "KC", "week": w, "gsis_id": "1", "position": "QB", "depth_team": "1"} for w in (1, 2)
    ]
    path = str(tmp_path / "depth")
    for r in rows:
        table, c = ing.incremental_append(raw_rows(spark, "raw_depth_charts", [r]), path, "raw_depth_charts")
        assert c.first().new_rows == 1
    assert table.count() == 2


@pytest.mark.parametrize("table", ["raw_nextgen_passing", "raw_nextgen_rushing", "raw_nextgen_receiving"])
def test_second_player_of_a_loaded_week_is_loaded(spark, tmp_path, table):
    path = str(tmp_path / "nextgen")
    for player in ("1", "2"):
        row = {"season": 2023, "week": 1, "season_type": "REG", "player_gsis_id": player}
        stored, c = ing.incremental_append(raw_rows(spark, table, [row]), path, table)
        assert c.first().new_rows == 1
    assert stored.count() == 2


def test_null_partition_keys_are_loaded_once(spark, tmp_path):
    rows = batch(spark, [("a", None, 1, 1.0), ("a", 2023, 1, 1.0)])
    path, keys = str(tmp_path / "t"), ["player_id", "season", "week"]
    for want in (2, 0):
        table, c = ing.incremental_append(rows, path, "t", keys, partition_by=["season"])
        assert c.first().new_rows == want
    assert table.count() == 2
    stream.append_unseen(rows, path, keys, ["season"])
    assert spark.read.schema(table.schema).parquet(path).count() == 2


def test_scope_outside_the_key_is_refused(spark, tmp_path):
    rows, path = batch(spark, [("a", 2023, 1, 1.0)]), str(tmp_path / "t")
    ing.incremental_append(rows, path, "t", ["player_id"])
    with pytest.raises(ValueError):
        ing.incremental_append(rows, path, "t", ["player_id"], scope=["season"])


def test_content_fingerprint_ignores_order_only(spark):
    one = batch(spark, [("a", 1, 1, 1.0), ("b", 2, 2, None), ("b", 2, 2, None)])
    first = ing.content_fingerprint(one).first().content_hash
    assert ing.content_fingerprint(one.orderBy(F.desc("player_id")).repartition(3)).first().content_hash == first
    assert ing.content_fingerprint(one.distinct()).first().content_hash != first
    assert ing.content_fingerprint(one.withColumn("week", F.lit(3))).first().content_hash != first


def test_fingerprint_depends_on_shape_only(spark):
    one = batch(spark, [("a", 1, 1, 1.0)])
    other = batch(spark, [("b", 2, 2, 2.0)])
    a, b = ing.fingerprint(one).first(), ing.fingerprint(other).first()
    text = "(1, 4)" + str(one.columns) + "4"
    assert a.batch_hash == b.batch_hash == hashlib.sha256(text.encode()).hexdigest()[:16]
    assert ing.fingerprint(one.union(other)).first().batch_hash != a.batch_hash


def test_loading_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, [("a", 2023, 1, 1.0), ("a", 2023, 1, 2.0), ("b", 2023, 1, 3.0)])
    table, c = ing.incremental_append(first, path, "t", ["player_id", "season", "week"], partition_by=["season"])
    assert table.count() == 3  # copies inside one batch are all kept
    assert (c.first().new_rows, c.first().skipped_rows) == (3, 0)
    second = batch(spark, [("a", 2023, 1, 9.0), ("c", 2024, 1, 4.0)])
    table, c = ing.incremental_append(second, path, "t", ["player_id", "season", "week"], partition_by=["season"])
    assert (c.first().total_rows, c.first().new_rows, c.first().skipped_rows) == (2, 1, 1)
    assert table.count() == 4 and table.filter("v = 9.0").count() == 0  # skipped, never updated
    table, c = ing.incremental_append(second, path, "t", ["player_id", "season", "week"], partition_by=["season"])
    assert table.count() == 4 and c.first().efficiency == 0


def test_counters_coverage_summary(spark):
    stored = ing.with_key_hash(batch(spark, [("a", 2023, 1, 1.0)]), ["player_id"])
    new = ing.with_key_hash(batch(spark, [("a", 2023, 1, 1.0), ("b", 2023, 1, 1.0)]), ["player_id"])
    c = ing.counters(ing.split_batch(new, stored), "t", 1.0)
    assert c.first().new_rows == 1 and c.first().efficiency == 50
    total = ing.run_summary(c.unionByName(ing.counters(ing.split_batch(new, None), "u", 3.0))).first()
    assert (total.total_operations, total.total_new_rows, total.overall_efficiency) == (2, 3, 75)
    assert (total.total_seconds, total.operations_per_second) == (4.0, 0.5)
    cover = ing.hash_coverage(stored.unionByName(new)).first()
    assert (cover.total_rows, cover.unique_hashes) == (3, 2)


def test_stream_is_idempotent_and_resumes(spark, tmp_path):
    src, target, state = (str(tmp_path / n) for n in ("src", "target", "state"))
    df = batch(spark, [("a", 2023, 1, 1.0), ("b", 2023, 1, 1.0)])
    df.write.parquet(src)

    def run(checkpoint):
        stream.incremental_stream(
            spark, src, df.schema, target, ["player_id", "season", "week"], checkpoint, max_files=1
        ).awaitTermination()
        return stream.stored_rows(spark, target, df.schema).count()

    assert run(state) == 2
    assert run(str(tmp_path / "fresh")) == 2  # replayed from scratch: all keys known
    batch(spark, [("b", 2023, 1, 7.0), ("c", 2023, 2, 1.0)]).write.mode("append").parquet(src)
    assert run(state) == 3


def test_cells_that_do_not_fit_are_listed(spark, tmp_path):
    from pyspark.sql import types as T

    from weekfold.sources import feeds

    schema = T.StructType.fromDDL("id bigint, n int, x double, day date, name string, absent int")
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.csv").write_text(
        "name,id,n,x,day,extra\nA,1,5,1.5,2020-01-02,z\nB,2,five,1.5,2020-01-02,z\nC,3,, 2 ,,z\nD,x,99999999999,nope,2020-13-02,z\n"
    )
    good, bad = feeds.read_fitting(spark, str(tmp_path), "feed", schema)
    assert good.schema == schema or [f.dataType for f in good.schema] == [f.dataType for f in schema]
    assert sorted((r.id, r.n, r.x, str(r.day), r.name, r.absent) for r in good.collect()) == [
        (1, 5, 1.5, "2020-01-02", "A", None), (3, None, 2.0, "None", "C", None)]
    cells = sorted((json.loads(r.row)["name"], r.column, r.value, r.type) for r in bad.collect())
    assert cells == [
        ("B", "n", "five", "int"), ("D", "day", "2020-13-02", "date"), ("D", "id", "x", "bigint"),
        ("D", "n", "99999999999", "int"), ("D", "x", "nope", "double"),
    ]
    # a refused row can be corrected and read again
    again, still = feeds.split_refused(spark.createDataFrame([("7", "8")], "id string, n string"), schema)
    assert again.first().n == 8 and still.count() == 0


def test_cells_are_cast_once_in_compiled_code_and_as_spark_casts_them(spark):
    from weekfold.sources import feeds

    texts = ["5", " 7 ", "+3", "-2", ".5", "1e3", "n/a", "NaN", "nano", "Inf", "-Infinity", "infinity ", "\t9", "\x7f8", "\u00a05", "٣", "0x1p3", "1d", ":", "~", ""]
    df = spark.createDataFrame([(t, t, t) for t in texts], "n string, x string, f string")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("f", T.FloatType())])
    judged = feeds.with_refusals(df.withColumn("given", F.col("n")), T.StructType([*schema.fields, T.StructField("given", T.StringType())]))
    plain = df.select(F.col("n").alias("given"), *[F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
    want = {r.given.strip(" "): (r.n, repr(r.x), repr(r.f)) for r in plain.collect()}
    got = judged.collect()
    assert {r.given.strip(" "): (r.n, repr(r.x), repr(r.f)) for r in got} == want
    for r in got:
        assert [c.column for c in r.refused] == [f for f in ("n", "x", "f") if r.given and r[f] is None]
    assert "lambda" not in judged._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_trees_of_two_loads_list_exactly_what_changed(spark):
    rows = [(i, ["a", "b", None][i % 3], f"v{i}", i / 7) for i in range(90)]
    kinds = "id bigint, part string, v string, x double"
    old = spark.createDataFrame(rows, kinds)
    same = ing.changed_parts(*[ing.hash_tree(d, ["part"], "id", 8) for d in (old, old.repartition(5))], ["part"])
    assert same.count() == 0
    changed = [(i, p, v if i != 4 else "other", x if i != 8 else None) for i, p, v, x in rows if i not in (0, 60)] + [(500, "new", "v", 1.0)]
    got = ing.changed_parts(
        ing.hash_tree(old, ["part"], "id", 8), ing.hash_tree(spark.createDataFrame(changed, kinds), ["part"], "id", 8), ["part"]
    ).collect()
    def count(data, part, bucket):
        return sum(1 for r in data if r[1] == part and r[0] % 8 == bucket)
    want = {("a", 0), ("a", 4), ("b", 4), (None, 0), ("new", 4)}  # 0; 60; 4; 8; 500
    assert {(r.part, r.bucket) for r in got} == want
    assert all((r.old_rows, r.new_rows) == (count(rows, r.part, r.bucket), count(changed, r.part, r.bucket)) for r in got)
