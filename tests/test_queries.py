"""The registry, and a sample of queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of
from weekfold.queries import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
QUICK = [
    "w00_rolling_all", "w09_period_rank", "p06_experience_band", "p13_period_from_timestamp", "a10_two_level",
    "t03_per_key_top_k", "u02_set_difference", "j04_team_game_join", "j10_roster_changes", "j14_last_meetings",
    "i03_new_row_filter", "f10_red_zone_shared_drive_ids", "f13_pace", "x02_json_array", "l09_area_under_roc",
]
NAMES = list(entry.oracle_sql()) if os.environ.get("WEEKFOLD_ALL_QUERIES") else QUICK


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    # what models say cannot be told by SQL; each of these has a query beside it that SQL checks
    fitted = {n for n in QUERIES if n not in ORACLES}
    assert fitted == {
        "l06_boosted_regression", "l07_boosted_classification", "l10_batch_score", "l11_feature_importance",
        "l12_hyperparameter_search", "l13_cross_validation", "l14_training_summary",
    }
    assert {n[:3] for n in fitted} <= {n[:3] for n in ORACLES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, ROOT)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables not present")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
