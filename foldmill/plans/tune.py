"""Search settings on a three-way split, refit the best, register it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from foldmill import schemas
from foldmill.operators import clean, evaluate, model, split, stats, tune
from foldmill.plans.train import SAMPLE_COLUMNS
from foldmill.session import new_folder, remove_folder
from foldmill.sources import registry, runs, tables


def search(
    spark: SparkSession, samples: DataFrame, registry_root: str, name: str, when: datetime,
    cols: model.Columns = SAMPLE_COLUMNS, trials: int = 5, executions: int = 1, seed: int = 42,
    runs_path: str | None = None, settings: list[dict] | None = None,
) -> dict:
    """The whole search over a stored, cleaned sample table; incomplete rows are left out."""
    kept = samples.select(cols.key, cols.label, *cols.numeric, *cols.categorical)
    path = new_folder(spark, "parts")
    tables.write_path(split.train_val_test(clean.drop_missing(kept), cols.key, seed), path)
    parts = tables.read_path(spark, path)
    classes = stats.class_list(parts, cols.label)

    found = tune.search(parts, cols, classes, trials, executions, seed, settings)
    names = found["plan"].names()

    parent = runs.Run(schemas.RUN_SEARCH, when)
    tried = settings or tune.trial_settings(trials, seed)
    for key, value in (("max_trials", len(tried)), ("executions_per_trial", executions), ("input_shape", len(names))):
        parent.param(key, value)
    reduced = evaluate.trial_reduce(found["results"]).collect()
    records = [parent]
    for setting in tried:
        child = parent.child(schemas.RUN_TRIAL.format(setting["trial"]))
        for key, value in setting.items():
            child.param(key, value)
        for r in reduced:
            if r["trial"] == setting["trial"]:
                child.metric(r["metric"], r["value"])
        records.append(child)
    for key, value in found["best"].items():
        parent.param(f"best_{key}", value)
    test = found["test"]
    if test["n_rows"]:
        parent.metric("test_accuracy", test["accuracy"])
        parent.metric("test_loss", test["loss"])
    version = registry.register(spark, registry_root, name, found["model"], parent.run_id, names, classes, when)
    if runs_path:
        runs.append_runs(spark, runs_path, records)
    reduced_results = found["results"].toArrow()  # a row per trial, execution and metric
    remove_folder(spark, path)
    found["plan"].discard(spark)  # the registered model has its own copy of the dictionary
    saved, _ = registry.load_latest(spark, registry_root, name)
    return found | {"version": version, "results": spark.createDataFrame(reduced_results), "model": saved}
