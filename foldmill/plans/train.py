"""Cross-validate, pass the gate, train on everything, register."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from foldmill import schemas
from foldmill.operators import clean, dense_net, evaluate, model, split, stats
from foldmill.session import new_folder, remove_folder
from foldmill.sources import registry, runs, tables

log = logging.getLogger(__name__)

SAMPLE_COLUMNS = model.Columns(
    key="row_key", label=schemas.LABEL, numeric=schemas.NUMERIC, categorical=schemas.CATEGORICAL
)


@dataclass
class Outcome:
    """What a training job decided: fold scores, their averages, and the version if one was registered."""

    fold_metrics: list[dict]
    avg_accuracy: float
    avg_loss: float
    majority_share: float
    version: int | None
    scores: dict


def train(
    spark: SparkSession, samples: DataFrame, registry_root: str, name: str, when: datetime,
    cols: model.Columns = SAMPLE_COLUMNS, folds: int = 5, threshold: float = 0.7, runs_path: str | None = None,
    setting: dense_net.Training | None = None, state: str | None = None,
) -> Outcome:
    """The whole training job over a stored, cleaned sample table with a unique key.

    With ``state``, a shared folder, finished epochs are kept there, and a job started again with the same table and settings goes on from them.
    """
    setting = setting or dense_net.Training(hidden=list(model.HIDDEN))
    clean.require_columns(samples, [cols.key, cols.label, *cols.numeric, *cols.categorical])
    clean.require_target(samples, cols.label)
    classes = stats.class_list(samples, cols.label)

    # Stored with its folds: every later pass reads just these columns and compares no hashes again.
    path = new_folder(spark, "folded")
    kept = samples.select(cols.key, cols.label, *cols.numeric, *cols.categorical)
    assigned = split.kfold(kept, cols.key, folds, setting.seed)
    tables.write_path(assigned, path)
    folded = tables.read_path(spark, path, assigned.schema)

    results = model.cross_validate(folded, folds, cols, classes, setting, state and f"{state}/folds")
    metrics = model.fold_metric_rows(spark, results)
    averaged = evaluate.cv_average(metrics)
    averages = {r["metric"]: r["value"] for r in averaged.collect()}
    gate = evaluate.quality_gate(averaged, "test_accuracy", threshold).first()
    share = evaluate.majority_share(folded, cols.label).first()[0]

    parent = runs.Run(schemas.RUN_CROSS_VALIDATION, when)
    records = [parent]
    for result in results:
        child = parent.child(schemas.RUN_FOLD.format(result["fold"]))
        child.metric("test_accuracy", result["test_accuracy"])
        child.metric("test_loss", result["test_loss"])
        child.history(result["history"])
        records.append(child)
    parent.metric("avg_test_accuracy", averages["test_accuracy"])
    parent.metric("avg_test_loss", averages["test_loss"])
    parent.metric("majority_share", share)

    version, scores = None, {}
    if gate["passed"]:
        final = runs.Run(schemas.RUN_FINAL, when)
        fitted, history, plan, scores = model.final_model(folded, cols, classes, setting, state=state and f"{state}/final")
        prepared, trained, saved = (final.child(step) for step in schemas.RUN_FINAL_STEPS)
        prepared.param("target_classes", classes)
        names = plan.names()  # the registry's row lists them
        prepared.param("n_features", plan.width)
        prepared.param("n_samples", scores.get("train_rows", 0) + scores.get("holdout_rows", 0))
        prepared.param("feature_names", names)
        trained.history(history.history)
        for key, value in scores.items():
            trained.metric(key, value)
        version = registry.register(
            spark, registry_root, name, fitted, final.run_id, names, classes, when
        )
        plan.discard(spark)
        saved.param("version", version)
        records += [final, prepared, trained, saved]
    else:
        log.warning("accuracy %.4f below %.2f: no final model", averages["test_accuracy"], threshold)
    if runs_path:
        runs.append_runs(spark, runs_path, records)
    remove_folder(spark, path)
    return Outcome(results, averages["test_accuracy"], averages["test_loss"], share, version, scores)
