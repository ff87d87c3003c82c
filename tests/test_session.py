"""The shared folder outside local sessions; the master's name is all that differs here."""

from __future__ import annotations

import pytest

from foldmill import session
from foldmill.queries import QUERIES


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    monkeypatch.setattr(session, "_SHARED", set(), raising=False)
    return spark


def named(monkeypatch, spark, folder):
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, key, *more: folder if key == "spark.checkpoint.dir" else get(conf, key, *more))
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)


def test_a_mounted_folder_is_taken(cluster, monkeypatch, tmp_path, sf_dir):
    named(monkeypatch, cluster, f"file://{tmp_path}")
    assert session.shared_folder(cluster) == f"file://{tmp_path}"
    assert QUERIES["append_merge_schema"](cluster, sf_dir).count() > 0
    assert not list((tmp_path / "foldmill").glob("try-*"))


def test_without_a_folder_the_warehouse_is_taken(cluster, monkeypatch):
    named(monkeypatch, cluster, None)
    folder = session.shared_folder(cluster)
    assert folder.startswith(cluster.conf.get("spark.sql.warehouse.dir"))


def test_a_folder_that_is_not_shared_is_refused(cluster, monkeypatch, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    named(monkeypatch, cluster, f"file://{blocked}/below")
    with pytest.raises(ValueError, match="all executors share"):
        session.shared_folder(cluster)


#: Queries that store tables.
STORING = [
    "assemble_features",
    "assemble_drop_first",
    "capture_once",
    "csv_declared_schema",
    "capture_predictions",
    "cv_average",
    "csv_inferred_schema",
    "cv_metrics",
    "decode_ids",
    "early_stop_epoch",
    "dictionary_codes",
    "early_stop_fit",
    "dictionary_onehot",
    "exact_moments",
    "feature_names",
    "fold_id_lists",
    "fold_fit_stats",
    "final_model",
    "fold_test_rows",
    "fold_train_rows",
    "folds_partitioned",
    "fold_transform",
]


@pytest.mark.parametrize("name", STORING)
def test_a_query_without_a_folder_stores_its_tables_in_the_warehouse(cluster, monkeypatch, tmp_path, sf_dir, name):
    named(monkeypatch, cluster, None)
    get = type(cluster.conf).get
    monkeypatch.setattr(type(cluster.conf), "get", lambda conf, key, *more: str(tmp_path) if key == "spark.sql.warehouse.dir" else get(conf, key, *more))
    assert QUERIES[name](cluster, sf_dir).count() > 0
    assert any(not kept.name.startswith("try-") for kept in (tmp_path / "foldmill_shared" / "foldmill").iterdir())
