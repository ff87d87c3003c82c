"""The whole jobs on a small CSV file with the columns of the sample table."""

from __future__ import annotations

import random
from datetime import datetime, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldmill.operators import clean, dense_net, model, stats
from foldmill.operators import score as scoring
from foldmill.plans import ingest, score, train, tune
from foldmill.schemas import SCORING
from foldmill.session import shared_folder
from foldmill.sources import runs

WHEN = datetime(2024, 1, 2, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    """Three classes apart in their measurements, with every spelling of missing and a repeated row."""
    rng = random.Random(1)
    centres = {"A": (39, 18, 190, 3700), "B": (49, 18, 196, 3730), "C": (47, 15, 217, 5070)}
    lines = ["species,island,culmen_length_mm,culmen_depth_mm,flipper_length_mm,body_mass_g,sex"]
    for i in range(330):
        name = "ABC"[i % 3]
        cells = [f"{rng.gauss(m, m * 0.02):.1f}" for m in centres[name]]
        if i % 40 == 0:
            cells = ["NA"] * 4
        lines.append(",".join([name, rng.choice("XYZ"), *cells, rng.choice(["MALE", "FEMALE", ".", ""])]))
    lines.append(lines[1])
    path = tmp_path_factory.mktemp("csv") / "samples.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def samples(spark, csv, tmp_path_factory):
    root = tmp_path_factory.mktemp("ingest")
    stored = ingest.ingest(spark, csv, f"{root}/samples", WHEN, f"{root}/runs", f"{root}/snapshot")
    return stored, str(root)


def test_ingest(spark, samples):
    stored, root = samples
    assert stored.count() == 331 and stored.select("row_key").distinct().count() == 331
    assert stored.filter("sex = '.'").count() == 0
    assert {r["key"]: r["num"] for r in runs.read_runs(spark, f"{root}/runs").filter("kind = 'metric'").collect()} == {
        "data_size": 331.0}
    assert spark.read.json(f"{root}/snapshot").count() == 331


def test_folds(spark, samples, tmp_path):
    _, root = samples
    table = ingest.make_folds(spark, f"{root}/samples", str(tmp_path / "folds"))
    assert sorted(r["count"] for r in table.groupBy("fold").count().collect()) == [66, 66, 66, 66, 67]
    lists = ingest.id_lists(table)
    assert lists.agg(F.sum(F.size("ids"))).first()[0] == 5 * 331


SETTING = dense_net.Training(hidden=list(model.HIDDEN), epochs=50)


def test_train_then_score(spark, samples, tmp_path):
    stored, _ = samples
    registry_root, log_path, runs_path = (str(tmp_path / n) for n in ("registry", "log", "runs"))
    outcome = train.train(spark, stored, registry_root, "classifier", WHEN, folds=3, runs_path=runs_path, setting=SETTING)
    assert outcome.avg_accuracy > 0.85 and outcome.majority_share < 0.4 and outcome.version == 1
    assert outcome.scores["train_rows"] + outcome.scores["holdout_rows"] == 331

    table = runs.read_runs(spark, runs_path)
    rolled = {r["key"]: r["avg_num"] for r in runs.rollup(table).filter("parent_name = 'cross-validation'").collect()}
    assert rolled["test_accuracy"] == pytest.approx(outcome.avg_accuracy)
    assert table.filter("key = 'val_loss' and run_name = 'model-training'").count() == SETTING.epochs

    scorer = score.BatchScorer(spark, registry_root, "classifier", log_path)
    batch = stored.select(*SCORING.fieldNames())
    scored = scorer.score(batch, WHEN)
    assert scored.count() == 331
    scorer.score(batch, WHEN)
    scorer.score(batch, WHEN, capture=False)
    logged = scoring.read_log(spark, log_path)
    assert logged.count() == 2 * 331
    assert logged.columns == [*SCORING.fieldNames(), "prediction", "confidence", "prediction_time"]
    assert logged.filter("island in ('None', 'nan')").count() == 0
    with_truth = scorer.score(stored, WHEN, capture=False)
    assert with_truth.filter("species = prediction").count() > 0.85 * 331
    with pytest.raises(clean.MissingColumnsError):
        scorer.score(batch.drop("sex"), WHEN)


def test_gate_stops_training_on_shuffled_labels(spark, samples, tmp_path):
    stored, _ = samples
    noise = stored.withColumn("species", F.element_at(F.array(*[F.lit(c) for c in "ABC"]),
                                                      (F.abs(F.xxhash64("row_key")) % 3 + 1).cast("int")))
    runs_path = str(tmp_path / "runs")
    outcome = train.train(spark, noise, str(tmp_path / "registry"), "classifier", WHEN, folds=3, runs_path=runs_path,
                          setting=dense_net.Training(hidden=list(model.HIDDEN), epochs=2))
    assert outcome.version is None and outcome.avg_accuracy < outcome.majority_share + 0.1
    assert runs.read_runs(spark, runs_path).filter("run_name = 'final-model'").count() == 0


def test_search(spark, samples, tmp_path):
    stored, _ = samples
    settings = [
        {"trial": 0, "learning_rate": 1e-6, "units": 32, "dropout_rate": 0.1, "batch_size": 32, "epochs": 10},
        {"trial": 1, "learning_rate": 5e-2, "units": 32, "dropout_rate": 0.1, "batch_size": 32, "epochs": 20},
    ]
    runs_path = str(tmp_path / "runs")
    found = tune.search(spark, stored, str(tmp_path / "registry"), "tuned", WHEN, settings=settings, runs_path=runs_path)
    assert found["best"]["trial"] == 1 and found["version"] == 1 and found["test"]["accuracy"] > 0.8
    params = {r["key"]: r["str"] for r in runs.read_runs(spark, runs_path).filter("run_name = 'hyperparameter-tuning'").collect()}
    assert params["best_units"] == "32" and params["max_trials"] == "2"


def test_perceptron(spark, samples):
    from foldmill.operators import features

    stored, _ = samples
    cols = train.SAMPLE_COLUMNS
    classes = stats.class_list(stored, "species")
    plan = features.fit_features(stored, cols.numeric, cols.categorical)
    fitted = model.fit_perceptron(stored, plan, cols, classes, iterations=30)
    assert model.evaluate_model(fitted, stored, "species", classes).first()["accuracy"] > 0.85


def test_batches_of_unlike_types_stay_readable(spark, tmp_path, make):
    """Whole numbers where the log has doubles, a column more, and one less; each batch is scored once."""
    from pyspark.sql import types as T

    path, calls = str(tmp_path / "log"), spark.sparkContext.accumulator(0)

    @F.arrow_udf("double")
    def counted(v: pa.Array) -> pa.Array:
        calls.add(len(v))
        return pa.array([0.5] * len(v))

    inputs = [T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())]
    for rows, schema in (([(1.5, "x")], "a double, b string"), ([(2, "y", 7)], "a int, b string, more int"), ([(3,)], "a int")):
        batch = make(rows, schema).withColumns({"prediction": F.lit("p"), "confidence": counted(F.col("a").cast("double"))})
        got = scoring.capture(clean.stamp_batch(batch, WHEN), path, inputs)
        assert got.count() == 1 and got.count() == 1
    assert calls.value == 3
    log = sorted((r["a"], r["b"] or "", r["more"] or "") for r in scoring.read_log(spark, path).collect())
    assert log == [(1.5, "x", ""), (2.0, "y", "7"), (3.0, "", "")]


def test_flows_leave_only_their_outputs(spark, samples, tmp_path):
    import os

    stored, _ = samples
    folder = os.path.join(shared_folder(spark), "foldmill")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    train.train(spark, stored, str(tmp_path / "r"), "m", WHEN, folds=2, setting=dense_net.Training([4], epochs=2))
    tune.search(spark, stored, str(tmp_path / "r"), "t", WHEN, settings=[{"trial": 0, "learning_rate": 1e-2, "units": 4, "dropout_rate": 0.1, "batch_size": 32, "epochs": 1}])
    assert set(os.listdir(folder)) <= before
