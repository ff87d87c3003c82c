"""Classifier fits, cross-validation and the final model."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill.operators import dense_net, evaluate, features, split, stats
from foldmill.schemas import FOLD_METRICS

# Hidden layer sizes of the standard network (fixed values).
HIDDEN = [10, 8]


@dataclass
class Columns:
    """Which columns of a sample table play which role."""

    key: str
    label: str
    numeric: list[str]
    categorical: list[str]


def with_target(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    return df.withColumn("target", features.target_ordinal(label, classes))


@dataclass
class Job:
    """One network to train: the fitted features, the settings, and the parts to hold out."""

    plan: features.FeaturePlan
    setting: dense_net.Training
    held: tuple[int, ...] = ()


def fit_dense(
    df: DataFrame, cols: Columns, classes: Sequence, jobs: Sequence[Job], part: Column | None = None,
    tasks: int | None = None, state: str | None = None, most: int | None = None,
) -> list[dense_net.Fitted]:
    """Train one network per job, all by the same passes; see :func:`as_pipeline` to apply one.

    ``part`` numbers the parts of the table that jobs may hold out; ``state`` and ``most`` are those of ``dense_net.train``.
    """
    with prepared(df, cols, classes, jobs, part, tasks) as (rows, members):
        return dense_net.train(rows, members, state, most)


@contextmanager
def prepared(
    df: DataFrame, cols: Columns, classes: Sequence, jobs: Sequence[Job], part: Column | None = None, tasks: int | None = None
) -> Iterator[tuple[DataFrame, list[dense_net.Member]]]:
    """The stored training rows and the network of each job, for any number of trainings; the rows are deleted in the end."""
    raw, views = features.coded_rows(with_target(df, cols.label, classes), [j.plan for j in jobs])
    part = F.lit(0) if part is None else part
    members = [dense_net.Member(view, len(classes), j.setting, j.held) for j, view in zip(jobs, views)]
    rows = dense_net.training_rows(raw, "raw", "target", part, cols.key, tasks, members)
    try:
        yield rows, members
    finally:
        dense_net.discard_rows(rows)


def as_pipeline(spark: SparkSession, plan: features.FeaturePlan, fitted: dense_net.Fitted) -> PipelineModel:
    """Features and network as one model that can be saved and applied to raw columns."""
    return PipelineModel([*plan.pipeline(spark).stages, fitted.model()])


def fit_perceptron(
    df: DataFrame, plan: features.FeaturePlan, cols: Columns, classes: Sequence,
    hidden: Sequence[int] = tuple(HIDDEN), iterations: int = 50, seed: int = 42,
) -> PipelineModel:
    """The same with Spark's own perceptron: sigmoid hidden units, fitted by L-BFGS over all rows."""
    stages = plan.pipeline(df.sparkSession)
    prepared = with_target(stages.transform(df), cols.label, classes)
    # Read once per iteration, so worth a shuffle that gives every core a share.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prepared.select(cols.key, "features", F.col("target").cast("double").alias("target")).repartition(tasks, cols.key)
    fit = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="target", probabilityCol="probability", predictionCol="prediction_index",
        layers=[plan.width, *hidden, len(classes)], maxIter=iterations, seed=seed,
    ).fit(spread.select("features", "target"))
    return PipelineModel([*stages.stages, fit])


def predict(model: PipelineModel, df: DataFrame, classes: Sequence) -> DataFrame:
    """The input columns with probability array, predicted class and confidence."""
    scored = model.transform(df)
    if dict(scored.dtypes)["probability"] != "array<double>":
        scored = scored.withColumn("probability", vector_to_array("probability"))
    return evaluate.with_prediction(scored.select(*df.columns, "probability"), "probability", classes)


def evaluate_model(model: PipelineModel, df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    scored = predict(model, df, classes)
    return evaluate.accuracy_and_loss(
        scored, label, "prediction", evaluate.true_probability("probability", label, classes)
    )


def cross_validate(
    folded: DataFrame, folds: int, cols: Columns, classes: Sequence, setting: dense_net.Training, state: str | None = None
) -> list[dict]:
    """Fresh transformers and a fresh network per fold, scored on the fold left out.

    Two passes over the table fit all folds' transformers, and one pass per epoch trains all folds' networks. The
    last held-out scores of a network are those of its final weights on its test fold.
    """
    plans = features.fit_fold_features(folded, folds, cols.numeric, cols.categorical)
    jobs = [Job(plans[f], setting, (f,)) for f in range(folds)]
    fits, results = fit_dense(folded, cols, classes, jobs, F.col("fold"), state=state), []
    plans[0].discard(folded.sparkSession)
    for fold, fitted in enumerate(fits):
        if not fitted.held_rows:
            raise ValueError(f"fold {fold} has no rows to test on")
        last = fitted.history[-1]
        results.append(
            {
                "fold": fold, "test_accuracy": last["val_accuracy"], "test_loss": last["val_loss"],
                "n_test": fitted.held_rows, "history": fitted.history,
            }
        )
    return results


def fold_metric_rows(spark, results: list[dict]) -> DataFrame:
    rows = [(r["fold"], m, r[m]) for r in results for m in ("test_accuracy", "test_loss")]
    return spark.createDataFrame(rows, FOLD_METRICS)


def final_model(
    df: DataFrame, cols: Columns, classes: Sequence, setting: dense_net.Training, share: float = 0.2, state: str | None = None
) -> tuple[PipelineModel, dense_net.Fitted, features.FeaturePlan, dict]:
    """Fit transformers on all rows and the network on all but the tail, which validates it."""
    plan = features.fit_features(df, cols.numeric, cols.categorical)
    marked = split.holdout_tail(df, cols.key, share, setting.seed, "held_out")
    [fitted] = fit_dense(marked, cols, classes, [Job(plan, setting, (1,))], F.col("held_out").cast("long"), state=state)
    # the last pass has scored the held-out rows with the final weights, and the train rows with those before the last update
    last, scores = fitted.history[-1], {}
    for name, prefix in (("train", ""), ("holdout", "val_")):
        if f"{prefix}accuracy" in last:
            scores |= {f"{name}_accuracy": last[f"{prefix}accuracy"], f"{name}_loss": last[f"{prefix}loss"]}
    scores |= {"train_rows": fitted.train_rows, "holdout_rows": fitted.held_rows}
    return as_pipeline(df.sparkSession, plan, fitted), fitted, plan, scores
