"""Where intermediate tables go, and when they are built again."""

import pytest

from weekfold import session
from weekfold.queries.stages import stage
from weekfold.session import refuse_unshared, shared_dir


@pytest.mark.parametrize("path, master, fs", [
    ("/tmp/x", "local[4]", "file:///"), ("file:/tmp/x", "local-cluster[2,1,1024]", "file:///"),
    ("hdfs://n/x", "yarn", "file:///"), ("/x", "yarn", "hdfs://n"), ("s3a://b/x", "spark://h:1", "file:///"),
])
def test_shared_folders_are_taken(path, master, fs):
    refuse_unshared(path, master, fs, False)


@pytest.mark.parametrize("path, fs", [("/tmp/x", "file:///"), ("file:/tmp/x", "hdfs://n"), ("file:///tmp/x", "hdfs://n")])
def test_local_folders_are_refused_on_a_cluster(path, fs):
    with pytest.raises(ValueError):
        refuse_unshared(path, "spark://host:7077", fs, False)
    refuse_unshared(path, "spark://host:7077", fs, True)


def test_the_session_has_a_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_changed_input_is_noticed(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/t.parquet")

    def rows():
        return stage(spark, root, "copy", lambda: spark.read.parquet(f"{root}/t.parquet")).count()

    assert rows() == 3 and rows() == 3
    spark.range(5).write.mode("append").parquet(f"{root}/t.parquet")
    assert rows() == 8


def test_a_named_folder_that_all_tasks_reach_is_taken_on_a_cluster(spark, tmp_path, monkeypatch):
    named = (tmp_path / "shared").as_uri()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_shared", set())
    monkeypatch.setattr(session, "_named_folder", lambda _: named)
    assert shared_dir(spark) == named
    monkeypatch.setattr(session, "written_everywhere", lambda *_: False)
    assert shared_dir(spark) == named  # tried once an application
    session._shared.clear()
    with pytest.raises(ValueError):
        shared_dir(spark)


def test_a_folder_where_rows_go_missing_is_not_shared(spark, tmp_path):
    assert session.written_everywhere(spark, str(tmp_path))
    (tmp_path / "file").write_text("")
    assert not session.written_everywhere(spark, str(tmp_path / "file"))


def test_without_a_named_folder_a_cluster_takes_the_warehouse_if_all_reach_it(spark, monkeypatch):
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_shared", set())
    monkeypatch.setattr(session, "_named_folder", lambda _: None)
    monkeypatch.setattr(session, "written_everywhere", lambda *_: False)
    with pytest.raises(ValueError):
        shared_dir(spark)
    monkeypatch.setattr(session, "written_everywhere", lambda *_: True)
    assert shared_dir(spark) == f"{warehouse}/weekfold-scratch"
