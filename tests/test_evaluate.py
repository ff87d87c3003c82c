from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from foldmill.operators import evaluate, score


def test_softmax_of_large_scores_is_finite(make):
    row = make([([1000.0, 999.0],)], "s array<double>").select(evaluate.softmax([F.col("s")[0], F.col("s")[1]])).collect()[0][0]
    assert row[0] == pytest.approx(1 / (1 + math.exp(-1))) and sum(row) == pytest.approx(1)


def test_first_class_wins_ties(make):
    df = evaluate.with_prediction(make([([0.4, 0.4, 0.2],)], "p array<double>"), "p", ["a", "b", "c"])
    assert tuple(df.select("prediction", "confidence").collect()[0]) == ("a", 0.4)


def test_loss_of_an_impossible_class_is_floored(make):
    df = make([("a", "b", 0.0)], "y string, prediction string, p double")
    row = evaluate.accuracy_and_loss(df, "y", "prediction", F.col("p")).collect()[0]
    assert row["accuracy"] == 0 and row["loss"] == pytest.approx(-math.log(1e-7))


def test_gate(make):
    averages = make([("test_accuracy", 0.7), ("test_loss", 9.0)], "metric string, value double")
    assert evaluate.quality_gate(averages).collect()[0]["passed"] is True
    assert evaluate.quality_gate(averages, threshold=0.71).collect()[0]["passed"] is False


def test_reduce_takes_the_lowest_loss_and_highest_accuracy(make):
    rows = [(0, 0, "val_loss", 2.0), (0, 1, "val_loss", 1.0), (0, 0, "val_accuracy", 0.5), (0, 1, "val_accuracy", 0.6),
            (1, 0, "val_accuracy", 0.6)]
    reduced = evaluate.trial_reduce(make(rows, "trial long, execution long, metric string, value double"))
    assert {(r["trial"], r["metric"]): r["value"] for r in reduced.collect()} == {
        (0, "val_loss"): 1.0, (0, "val_accuracy"): 0.6, (1, "val_accuracy"): 0.6}
    assert evaluate.best_trial(reduced).collect()[0]["trial"] == 0


def stop_by_hand(losses, patience):
    """The stop rule step by step."""
    best, best_step, wait = math.inf, 0, 0
    for step, loss in enumerate(losses):
        if loss < best:
            best, best_step, wait = loss, step, 0
        else:
            wait += 1
            if wait >= patience:
                return best_step, step
    return best_step, len(losses) - 1


@pytest.mark.parametrize(
    "losses", [[3, 2, 1], [1, 2, 3, 4, 5], [3, 2, 2, 2, 2, 1], [5, 4, 6, 3, 4, 5, 6, 1], [1.0], [2, 1, 1.5, 1.2, 0.9, 1, 1, 1]]
)
def test_early_stop_follows_the_rule(make, losses):
    history = make([("r", i, float(v)) for i, v in enumerate(losses)], "run string, step long, val_loss double")
    row = evaluate.early_stop(history, "run", 3).collect()[0]
    assert (row["best_step"], row["stop_step"]) == stop_by_hand(losses, 3)


def test_unknown_index_has_no_label(make):
    out = score.index_to_label(make([(0,), (5,), (None,)], "i long"), "i", ["a", "b"]).collect()
    assert [r["prediction"] for r in out] == ["a", None, None]
