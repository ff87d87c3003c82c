from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.ml import PipelineModel

from foldmill.operators import dense_net
from foldmill.operators.dense_net import initial_weights
from foldmill.schemas import SAMPLE
from foldmill.sources import registry, runs, tables

WHEN = datetime(2024, 1, 2, tzinfo=timezone.utc)
HEADER = "species,island,culmen_length_mm,culmen_depth_mm,flipper_length_mm,body_mass_g,sex\n"


def test_csv_null_spellings(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + "Adelie,X,NA,,1.5,2,NA\nGentoo,Y,3,4,5,6,.\n")
    rows = tables.read_csv(spark, str(path), SAMPLE).collect()
    assert rows[0]["culmen_length_mm"] is None and rows[0]["culmen_depth_mm"] is None and rows[0]["sex"] is None
    assert rows[1]["sex"] == "."


def test_csv_with_another_column_order_is_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("island,species" + HEADER[len("species,island"):] + "X,Adelie,1,2,3,4,MALE\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(path), SAMPLE).collect()


def test_csv_inferred(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + "Adelie,X,1.5,NA,1,2,MALE\n")
    assert dict(tables.read_csv(spark, str(path), infer=True).dtypes)["culmen_length_mm"] == "double"


def test_next_version_may_read_the_last(spark, tmp_path):
    first = tables.write_version(spark.range(5), str(tmp_path))
    second = tables.write_version(tables.read_path(spark, first).filter("id > 2"), str(tmp_path))
    assert tables.read_path(spark, first).count() == 5 and tables.read_path(spark, second).count() == 2


def test_named_table_is_replaced_and_truncated(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS fm LOCATION '{tmp_path / 'db'}'")
    tables.write_name(spark.range(3), "fm.t")
    assert tables.write_name(spark.range(4).withColumnRenamed("id", "x"), "fm.t").columns == ["x"]
    assert tables.read_name(spark, "fm.t").count() == 4
    tables.truncate(spark, "fm.t")
    assert tables.read_name(spark, "fm.t").count() == 0
    spark.sql("DROP DATABASE fm CASCADE")


def test_append_with_a_new_column(spark, tmp_path, make):
    path = str(tmp_path / "log")
    tables.append(make([(1,)], "a long"), path)
    tables.append(make([(2, "x")], "a long, b string"), path)
    tables.append(make([(1,)], "a long"), path)
    rows = sorted((r["a"], r["b"]) for r in tables.read_merged(spark, path).fillna("-").collect())
    assert rows == [(1, "-"), (1, "-"), (2, "x")]


def test_one_fold_reads_only_its_directory(spark, tmp_path, make, capsys):
    df = make([(0, "train", 1), (0, "test", 2), (1, "train", 3)], "fold long, role string, v long")
    tables.write_folds(df, str(tmp_path / "f"))
    part = tables.read_fold(spark, str(tmp_path / "f"), 0, "test")
    assert [r["v"] for r in part.collect()] == [2]
    part.explain()
    assert "PartitionFilters: [isnotnull(fold" in capsys.readouterr().out


def test_snapshot_keeps_nulls(spark, tmp_path, make):
    df = make([("a", None), (None, 1.0)], "s string, v double")
    tables.write_snapshot(df, str(tmp_path / "s"))
    assert sorted(map(repr, tables.read_snapshot(spark, str(tmp_path / "s"), df.schema).collect())) == sorted(map(repr, df.collect()))


def test_newest_version_is_loaded(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(registry.NoModelError):
        registry.load_latest(spark, root, "m")
    for seed in (1, 2):
        fitted = dense_net.Fitted([2, 3, 2], initial_weights([2, 3, 2], seed))
        version = registry.register(spark, root, "m", PipelineModel([fitted.model()]), f"run{seed}", ["f"], ["x", "y"], WHEN)
        assert version == seed
    loaded, row = registry.load_latest(spark, root, "m")
    assert row["version"] == 2 and row["run_id"] == "run2" and row["target_classes"] == ["x", "y"]
    stage = loaded.stages[0]
    assert stage.getOrDefault(stage.weights) == pytest.approx(list(initial_weights([2, 3, 2], 2)))
    with pytest.raises(registry.NoModelError):
        registry.load_latest(spark, root, "other")


def test_runs_roll_up_to_their_parent(spark, tmp_path):
    parent = runs.Run("cv", WHEN)
    children = [parent.child(f"fold-{i}") for i in range(2)]
    for i, child in enumerate(children):
        child.param("fold", i)
        child.metric("test_accuracy", 0.5 + i / 10)
        child.history([{"step": 0, "loss": 9.0, "accuracy": 0.1}, {"step": 1, "loss": 1.0 + i, "accuracy": 0.2}])
    path = str(tmp_path / "runs")
    runs.append_runs(spark, path, [parent, *children])
    found = {r["key"]: (r["avg_num"], r["n_children"]) for r in runs.rollup(runs.read_runs(spark, path)).collect()}
    assert found["test_accuracy"] == (pytest.approx(0.55), 2)
    assert found["train_loss"] == (pytest.approx(1.5), 2)


def test_another_format(spark, tmp_path):
    path = str(tmp_path / "orc")
    tables.write_path(spark.range(4), path, fmt="orc")
    tables.append(spark.range(3), path, fmt="orc")
    assert tables.read_path(spark, path, fmt="orc").count() == 7
