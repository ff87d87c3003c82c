"""One writer wins: version claims, committed batches, replaced tables; inferred types and run trees at their edges."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import types as T

from foldmill.operators import dense_net, score
from foldmill.operators.dense_net import initial_weights
from foldmill.sources import files, registry, runs, tables

WHEN = datetime(2024, 1, 2, tzinfo=timezone.utc)


def test_a_file_is_made_once_with_its_whole_content(spark, tmp_path):
    path = str(tmp_path / "a" / "claim")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: files.create(spark, path, f"writer {i}"), range(8)))
    assert won.count(True) == 1 and files.exists(spark, path)
    assert (tmp_path / "a" / "claim").read_text() == f"writer {won.index(True)}"
    assert [f for f in os.listdir(tmp_path / "a") if not f.endswith(".crc")] == ["claim"]


def fitted(seed: int) -> PipelineModel:
    return PipelineModel([dense_net.Fitted([2, 3, 2], initial_weights([2, 3, 2], seed)).model()])


def test_eight_registrations_at_once(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda i: registry.register(spark, root, "a model/x", fitted(i), f"run{i}", ["f"], ["x"], WHEN), range(8)))
    assert sorted(versions) == list(range(1, 9))
    found = {r["version"]: r["run_id"] for r in registry.rows(spark, root).collect()}
    assert found == {v: f"run{i}" for i, v in enumerate(versions)}
    loaded, row = registry.load_latest(spark, root, "a model/x")
    assert row["version"] == 8 and row["trained_at"].replace(tzinfo=None) == datetime(2024, 1, 2)
    stage = loaded.stages[0]
    assert stage.getOrDefault(stage.weights) == pytest.approx(list(initial_weights([2, 3, 2], versions.index(8))))


def test_a_claim_without_a_model_is_not_a_version(spark, tmp_path):
    root = str(tmp_path)
    registry.register(spark, root, "m", fitted(1), "run1", ["f"], ["x"], WHEN)
    assert registry.claim(spark, root, "m") == 2
    assert registry.load_latest(spark, root, "m")[1]["version"] == 1
    assert registry.register(spark, root, "m", fitted(3), "run3", ["f"], ["x"], WHEN) == 3
    assert registry.load_latest(spark, root, "m")[1]["run_id"] == "run3"


INPUTS = [T.StructField("a", T.DoubleType())]
BATCH = "a double, prediction string, confidence double, prediction_time timestamp"


def test_a_batch_is_in_the_log_once(spark, tmp_path, make):
    path = str(tmp_path / "log")
    one = make([(1.0, "p", 0.5, WHEN)], BATCH)
    two = make([(2.0, "q", 0.5, WHEN)], BATCH)
    assert score.capture(one, path, INPUTS, batch="007").collect() == score.capture(two, path, INPUTS, batch="007").collect()
    lost = score.write_attempt(score.log_rows(two, INPUTS), path, "007")  # a job that finished second
    assert not score.commit(spark, path, "007", lost)
    score.write_attempt(score.log_rows(two, INPUTS), path, "8/å")  # a job that ended before its commit
    assert [r["a"] for r in score.read_log(spark, path).collect()] == [1.0]
    score.capture(two, path, INPUTS, batch="8/å")
    score.capture(two, path, INPUTS, batch="7")
    assert sorted(r["a"] for r in score.read_log(spark, path).collect()) == [1.0, 2.0, 2.0]
    assert score.read_log(spark, path).columns == ["a", "prediction", "confidence", "prediction_time"]


def test_two_jobs_capture_one_batch(spark, tmp_path, make):
    path, rows = str(tmp_path / "log"), make([(float(i), "p", 0.5, WHEN) for i in range(20)], BATCH)
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: score.capture(rows, path, INPUTS, batch="b").count(), range(4)))
    assert got == [20] * 4 and score.read_log(spark, path).count() == 20


def test_a_failed_write_leaves_nothing_in_the_log(spark, tmp_path, make):
    from pyspark.sql import functions as F

    path, rows = str(tmp_path / "log"), make([(float(i), "p", 0.5, WHEN) for i in range(20)], BATCH)
    score.capture(rows.limit(3), path, INPUTS, batch="a")
    broken = rows.withColumn("a", F.when(F.col("a") < 19, F.col("a")).otherwise(F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        score.capture(broken, path, INPUTS, batch="b")
    assert score.read_log(spark, path).count() == 3
    score.capture(rows, path, INPUTS, batch="b")
    assert score.read_log(spark, path).count() == 23


def test_a_replaced_table_and_plans_made_before(spark, tmp_path):
    root = str(tmp_path / "versions")
    spark.sql("DROP TABLE IF EXISTS fm_replaced")
    before = tables.replace_name(spark.range(10), "fm_replaced", root)
    assert tables.replace_name(tables.read_name(spark, "fm_replaced").filter("id > 6"), "fm_replaced", root).count() == 3
    assert before.count() == 10 and spark.table("fm_replaced").count() == 3
    assert tables.empty_name(spark, "fm_replaced", root).count() == 0 == spark.table("fm_replaced").count()
    assert before.count() == 10
    other = tables.replace_name(spark.range(2).selectExpr("id", "'x' as s"), "fm_replaced", root)
    assert other.columns == ["id", "s"] and spark.table("fm_replaced").count() == 2
    spark.sql("DROP TABLE fm_replaced")


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "i,d,b,day,time,year,mixed,none,big,text,half\n"
        "1,1.5,true,2024-01-02,2024-01-02 03:04:05,2024,1,NA,99999999999999999999,1d,1\n"
        "NA,.,FALSE,NA,.,1999,x,.,1,2f,0.5\n"
        " -7 ,1e3,,2024-02-29,2024-01-02T03:04:05,.,2.0,,2,NaN,.5\n"
    )
    got = tables.infer_csv(spark, str(path))
    assert dict(got.dtypes) == {
        "i": "bigint", "d": "double", "b": "boolean", "day": "date", "time": "timestamp", "year": "bigint", "mixed": "string", "none": "string",
        "big": "double", "text": "string", "half": "double",
    }
    rows = got.collect()
    assert [r["i"] for r in rows] == [1, None, -7] and [r["d"] for r in rows] == [1.5, None, 1000.0] and [r["b"] for r in rows] == [True, False, None]
    assert [r["none"] for r in rows] == [None] * 3 and [r["mixed"] for r in rows] == ["1", "x", "2.0"]


def test_an_impossible_date_is_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("day\n2024-02-30\n2024-02-01\n")
    assert tables.infer_csv(spark, str(path)).dtypes == [("day", "string")]


def test_run_trees_of_any_depth_and_rings(spark):
    top = runs.Run("r0", WHEN, run_id="0")
    chain = [top]
    for i in range(1, 150):  # deeper than the usual limit of recursive queries
        chain.append(runs.Run(f"r{i}", WHEN, chain[-1], str(i)))
    chain[-1].metric("loss", 4.0)
    chain[70].history([{"step": 0, "loss": 9.0}, {"step": 1, "loss": 2.0}])
    lone = runs.Run("lone", WHEN, run_id="lone")
    a, b = runs.Run("a", WHEN, run_id="a"), runs.Run("b", WHEN, run_id="b")
    a.parent, b.parent = b, a
    for ring in (a, b):
        ring.records = []
        ring._add("run", "started", None, None, None)
    got = runs.run_tree(runs.run_rows(spark, [*chain, lone, a, b])).collect()
    found = {(r["run_id"], r["key"]): r for r in got}
    assert "a" not in {r["run_id"] for r in got} and found["lone", None]["avg_num"] is None
    assert found["149", "loss"]["depth"] == 149 and found["149", "loss"]["root_id"] == "0" and found["149", "loss"]["path"].count("/") == 149
    assert found["100", "loss"]["avg_num"] == 4.0 and found["100", "loss"]["n_runs"] == 1
    assert found["0", "train_loss"]["avg_num"] == 2.0 and found["0", "loss"]["avg_num"] == 4.0
