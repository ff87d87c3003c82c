"""Metrics, their averages, and the decisions taken on them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probabilities are kept this far from zero before the logarithm (fixed value).
PROBABILITY_FLOOR = 1e-7


def softmax(scores: Sequence[Column]) -> Column:
    """Array of class probabilities from one score column per class, shifted by the maximum so that exp stays finite.

    Plain columns rather than functions over an array: those would leave generated code.
    """
    highest = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = [F.exp(s - highest) for s in scores]
    total = reduce(lambda a, b: a + b, raised)
    return F.array(*[e / total for e in raised])


def listed(values: Sequence) -> Column:
    """A constant array of texts as one expression, however many there are."""
    return F.from_json(F.lit(json.dumps([str(v) for v in values])), "array<string>")


def with_prediction(df: DataFrame, probability: str, classes: Sequence[str]) -> DataFrame:
    """Most probable class (the first one on ties) and its probability."""
    names = listed(classes)
    best = F.array_max(probability)
    return df.withColumns(
        {
            "prediction": F.element_at(names, F.array_position(probability, best).cast("int")),
            "confidence": best,
        }
    )


def true_probability(probability: str | Column, label: str, classes: Sequence[str]) -> Column:
    names = listed(classes)
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.element_at(p, F.array_position(names, F.col(label).cast("string")).cast("int"))


def row_loss(p_true: Column) -> Column:
    return -F.ln(F.greatest(p_true, F.lit(PROBABILITY_FLOOR)))


def accuracy_and_loss(
    df: DataFrame, label: str, prediction: str, p_true: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Share of hits and mean cross-entropy, in one pass."""
    hit = F.when(F.col(prediction) == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.avg(hit).alias("accuracy"), F.avg(row_loss(p_true)).alias("loss")
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def majority_share(df: DataFrame, label: str) -> DataFrame:
    """What a constant prediction would score: the number an accuracy has to beat."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("majority_share"))


def cv_average(fold_metrics: DataFrame) -> DataFrame:
    """Mean over folds of a long ``(fold, metric, value)`` table."""
    return fold_metrics.groupBy("metric").agg(F.avg("value").alias("value"), F.count("*").alias("n_folds"))


def quality_gate(averages: DataFrame, metric: str = "test_accuracy", threshold: float = 0.7) -> DataFrame:
    return averages.filter(F.col("metric") == metric).select(
        "metric", "value", F.lit(threshold).alias("threshold"), (F.col("value") >= threshold).alias("passed")
    )


def trial_reduce(results: DataFrame) -> DataFrame:
    """Best value over repeated executions: the lowest for losses, the highest for accuracies."""
    best = F.when(F.col("metric").endswith("loss"), F.min("value")).otherwise(F.max("value"))
    return results.groupBy("trial", "metric").agg(best.alias("value"))


def best_trial(reduced: DataFrame, metric: str = "val_accuracy") -> DataFrame:
    """The trial with the highest metric, the lowest number on ties."""
    rank = F.struct(F.col("value"), -F.col("trial"))
    return reduced.filter(F.col("metric") == metric).agg(
        F.max_by("trial", rank).alias("trial"), F.max("value").alias("value")
    )


class EarlyStop:
    """Stops once ``patience`` steps in a row brought no lower loss; without patience it only remembers the best step."""

    def __init__(self, patience: int | None = None):
        self.patience, self.best_step, self.best_loss, self.stopped = patience, None, float("inf"), False

    def see(self, step: int, loss: float) -> bool:
        """Whether this step is the best so far; ``stopped`` tells whether it is the last."""
        if loss < self.best_loss:
            self.best_step, self.best_loss = step, loss
            return True
        first = 0 if self.best_step is None else self.best_step
        self.stopped = bool(self.patience) and step - first >= self.patience
        return False


def early_stop(history: DataFrame, run: str, patience: int = 3) -> DataFrame:
    """Per run of ``(run, step, val_loss)``: the best step seen before stopping, and the step it stops at.

    Each run's curve is followed by :class:`EarlyStop`, as in training; a run has as many rows as it has epochs.
    """

    def follow(key, curve):
        import pandas as pd

        rule, last = EarlyStop(patience), None
        for step, loss in curve.sort_values("step")[["step", "val_loss"]].itertuples(index=False):
            last = step
            rule.see(step, loss)
            if rule.stopped:
                break
        return pd.DataFrame([[key[0], rule.best_step, last, rule.best_loss]], columns=[run, "best_step", "stop_step", "best_loss"])

    kind = history.schema[run].dataType.simpleString()
    schema = f"`{run}` {kind}, best_step bigint, stop_step bigint, best_loss double"
    return history.groupBy(run).applyInPandas(follow, schema)
