"""Queries whose intermediate tables go to a named folder, under a master that is not local."""

import pytest

from weekfold import session
from weekfold.queries import QUERIES, stages

ROOT = "/root/testdata/sf0.001"
ON_CLUSTER = [
    "f15_dataset_summary",
    "f15_vector_assembly",
    "g01_prediction_targets",
    "g01_target_summary",
    "g02_no_target_flag",
    "i03_stored_keys",
    "i04_changed_parts",
    "i08_continuous_load",
    "i05_incremental_append",
    "i08_keyed_stream",
    "l02_ratio_split",
    "l01_training_read",
    "l03_feature_matrix",
    "l04_target_column",
    "l05_position_targets",
    "l06_boosted_regression",
    "l06_fit_by_split",
    "l07_fit_by_label",
    "l07_boosted_classification",
    "l09_area_under_roc",
    "l09_classification_metrics",
    "l10_batch_score",
]


@pytest.fixture(scope="module")
def cluster(spark, tmp_path_factory):
    """The session as on a cluster: a named folder on a plain file system, no stage built yet."""
    named = tmp_path_factory.mktemp("shared").as_uri()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(spark.sparkContext, "master", "spark://host:7077")
        patch.setattr(session, "_shared", set())
        patch.setattr(session, "_named_folder", lambda _: named)
        patch.setattr(stages, "_built", {})
        yield spark


@pytest.mark.parametrize("name", ON_CLUSTER)
def test_a_query_ends_on_a_cluster(cluster, name):
    assert QUERIES[name](cluster, ROOT).count() > 0
