from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldmill.operators import dense_net, features, model
from foldmill.operators.dense_net import Member, Training, Updater, _gradient, _score, initial_weights, probabilities, weight_count

LAYERS = [3, 5, 4, 3]
# Three columns taken as they are.
PLAIN = features.View(np.arange(3), np.zeros(3), np.ones(3), [], 3)


def data(n=60, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    return x, (x @ np.array([[2.0, -1, 0], [0, 1, 1], [-1, 0, 2]])).argmax(axis=1)


def rows_of(spark, x, y, held=None, partitions=3):
    held = np.zeros(len(y), bool) if held is None else held
    rows = [(i, [float(v) for v in a], int(b), int(h)) for i, (a, b, h) in enumerate(zip(x, y, held))]
    df = spark.createDataFrame(rows, "id long, raw array<double>, target long, held long").repartition(partitions)
    return df.withColumn("features", array_to_vector("raw"))


def fit(df, *settings, tasks=None, held=(1,)):
    rows = dense_net.training_rows(df, "raw", "target", F.col("held"), "id", tasks)
    return dense_net.train(rows, [Member(PLAIN, 3, s, held) for s in settings])


def test_gradient_equals_finite_differences():
    x, y = data(20)
    flat = initial_weights(LAYERS, 1) + 0.05
    gradient, _ = _gradient(flat, LAYERS, x, y)
    for k in range(0, len(flat), 3):
        step = np.zeros_like(flat)
        step[k] = 1e-6
        up, down = (_score(probabilities(flat + s, LAYERS, x), y)[1] for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_probabilities_sum_to_one():
    x, _ = data()
    assert probabilities(initial_weights(LAYERS, 3), LAYERS, x * 100).sum(axis=1) == pytest.approx(1.0)


def test_sgd_equals_plain_gradient_steps(spark):
    x, y = data()
    [fitted] = fit(rows_of(spark, x, y), Training([5, 4], epochs=3, rate=0.3, optimizer="sgd"))
    flat = initial_weights(LAYERS, 42)
    for _ in range(3):
        flat = flat - 0.3 * _gradient(flat, LAYERS, x, y)[0] / len(y)
    assert fitted.weights == pytest.approx(flat)


def test_weights_do_not_depend_on_tasks_or_batches(spark):
    """The same for 1, 4 and 16 tasks, for small and large Arrow batches, and for another spread of the input."""
    x, y = data(900)
    setting, got = Training([5, 4], epochs=6), []
    for tasks, batch, partitions in ((1, 10_000, 1), (4, 100, 3), (16, 10_000, 7), (16, 7, 2)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        try:
            got.append(fit(rows_of(spark, x, y, partitions=partitions), setting, tasks=tasks)[0].weights)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for other in got[1:]:
        assert other == pytest.approx(got[0], abs=1e-9)


def test_copies_of_the_table_give_the_same_weights(spark):
    """The algorithm does not change with the number of rows."""
    x, y = data(300)
    setting = Training([5], epochs=5)
    once, often = (fit(rows_of(spark, np.tile(x, (k, 1)), np.tile(y, k)), setting)[0].weights for k in (1, 200))
    assert often == pytest.approx(once, abs=1e-9)


def test_training_together_equals_training_alone(spark):
    x, y = data(150)
    held = np.arange(150) % 5 == 0
    settings = [Training([5, 4], epochs=2, optimizer="sgd"), Training([7], epochs=4), Training([5], epochs=3, rate=0.5)]
    df = rows_of(spark, x, y, held)
    together = fit(df, *settings, tasks=2)
    for setting, joint in zip(settings, together):
        [alone] = fit(df, setting, tasks=2)
        assert joint.weights == pytest.approx(alone.weights, abs=1e-12)
        assert joint.history == [pytest.approx(h) for h in alone.history] and len(joint.history) == setting.epochs


@pytest.mark.parametrize("optimizer,rate", [("sgd", 0.5), ("adam", 0.05)])
def test_learning_lowers_the_loss(spark, optimizer, rate):
    x, y = data(300)
    [fitted] = fit(rows_of(spark, x, y), Training([16], epochs=20, rate=rate, optimizer=optimizer), tasks=2)
    assert fitted.history[-1]["loss"] < 0.7 * fitted.history[0]["loss"]


def test_rows_with_slots_equal_dense_rows():
    rng = np.random.default_rng(0)
    rows = features.Rows(rng.normal(size=(40, 2)), [rng.integers(-1, 3, 40) + 2 * (rng.random(40) > 2), rng.integers(0, 4, 40) + 5], 9)
    rows.slots[0] = np.where(rows.slots[0] >= 0, rows.slots[0] + 2, -1)
    w, delta = rng.normal(size=(9, 5)), rng.normal(size=(40, 5))
    assert rows.times(w) == pytest.approx(rows.dense() @ w)
    assert rows.times_transposed(delta) == pytest.approx(rows.dense().T @ delta)


def test_history_scores_the_weights_of_its_epoch(spark):
    x, y = data(120)
    held = np.arange(120) % 4 == 0
    [fitted] = fit(rows_of(spark, x, y, held), Training([5, 4], epochs=2, rate=0.2, optimizer="sgd"))
    n, loss, hits = _score(probabilities(fitted.weights, LAYERS, x[held]), y[held])
    assert len(fitted.history) == 2 and fitted.held_rows == n
    assert fitted.history[-1]["val_loss"] == pytest.approx(loss / n)
    assert fitted.history[-1]["val_accuracy"] == pytest.approx(hits / n)


def test_early_stop_keeps_the_best_weights(spark):
    x, y = data(120)
    held = np.arange(120) % 3 == 0
    y = np.where(held, np.random.default_rng(1).integers(0, 3, 120), y)
    [fitted] = fit(rows_of(spark, x, y, held), Training([5, 4], epochs=30, rate=2.0, optimizer="sgd", patience=2))
    losses = [h["val_loss"] for h in fitted.history if "val_loss" in h]
    assert len(fitted.history) < 30 and fitted.best_epoch == int(np.argmin(losses))
    n, loss, _ = _score(probabilities(fitted.weights, LAYERS, x[held]), y[held])
    assert loss / n == pytest.approx(min(losses))


def test_no_train_rows_is_an_error(spark):
    x, y = data(5)
    with pytest.raises(ValueError, match="no rows"):
        fit(rows_of(spark, x, y, np.ones(5, bool)), Training([5], epochs=1))


def test_adam_moves_against_the_gradient():
    update = Updater("adam", 0.1, 2)
    state = update.start(np.array([1.0, -1.0]))
    update.apply(state, np.array([0.5, -0.5]))
    assert state[:2] == pytest.approx([0.9, -0.9], abs=1e-4)


def test_saved_model_predicts_the_same(spark, tmp_path):
    x, y = data(30)
    flat = initial_weights(LAYERS, 7)
    fitted = PipelineModel([dense_net.Fitted(LAYERS, flat).model()])
    df = rows_of(spark, x, y)
    fitted.write().save(str(tmp_path / "m"))
    out = [PipelineModel.load(str(tmp_path / "m")), fitted]
    got = [[r["probability"] for r in m.transform(df).orderBy("id").collect()] for m in out]
    assert got[0] == got[1]
    assert np.array(got[0]) == pytest.approx(probabilities(flat, LAYERS, x))
    best = model.predict(fitted, df.select("id", "features"), ["a", "b", "c"]).orderBy("id").collect()
    assert [r["prediction"] for r in best] == ["abc"[i] for i in probabilities(flat, LAYERS, x).argmax(axis=1)]
    assert all(r["confidence"] == max(r["probability"]) for r in best)


def test_weight_count_matches():
    assert weight_count(LAYERS) == len(initial_weights(LAYERS, 0))


def test_more_tasks_than_rows(spark):
    x, y = data(3)
    assert len(fit(rows_of(spark, x, y), Training([5], epochs=1), tasks=6)[0].history) == 1


def test_cross_validation_scores_are_those_of_the_test_fold(spark):
    from foldmill.operators import split

    df = spark.range(400).select(
        "id", (F.col("id") % 7).cast("double").alias("v"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("s"),
        F.when(F.col("id") % 7 > 3, "b").otherwise("a").alias("y"),
    )
    folded = split.kfold(df, "id", 3)
    cols = model.Columns("id", "y", ["v"], ["s"])
    setting = Training([6], epochs=3)
    results = model.cross_validate(folded, 3, cols, ["a", "b"], setting)
    plans = features.fit_fold_features(folded, 3, ["v"], ["s"])
    for fold in range(3):
        [fitted] = model.fit_dense(folded, cols, ["a", "b"], [model.Job(plans[fold], setting, (fold,))], F.col("fold"))
        pipeline = model.as_pipeline(spark, plans[fold], fitted)
        scores = model.evaluate_model(pipeline, split.test_rows(folded, fold), "y", ["a", "b"]).first()
        assert results[fold]["n_test"] == scores["n_rows"]
        assert results[fold]["test_accuracy"] == pytest.approx(scores["accuracy"])
        assert results[fold]["test_loss"] == pytest.approx(scores["loss"])


def bits(seed: int, epoch: int, key, units: int) -> list[int]:
    """16 bits for each unit, from the digests of its block."""
    digests = [hashlib.md5(f"{seed}:{epoch}:{key}:{block}".encode()).hexdigest() for block in range(-(-units // 8))]
    return [int(digests[u // 8][4 * (u % 8) : 4 * (u % 8) + 4], 16) for u in range(units)]


def buckets_of(n: int) -> np.ndarray:
    return np.array([int(hashlib.md5(f"bucket:{i}".encode()).hexdigest()[:8], 16) % dense_net.BUCKETS for i in range(n)])


def plain_descent(x, y, setting: Training) -> np.ndarray:
    """SGD by slices with dropout, with numpy alone."""
    layers = [3, *setting.hidden, 3]
    flat, own = initial_weights(layers, setting.seed), buckets_of(len(y))
    ends = np.cumsum(setting.hidden)
    for epoch in range(setting.epochs):
        drawn = np.array([bits(setting.seed, epoch, i, sum(setting.hidden)) for i in range(len(y))])
        kept = (drawn >= setting.dropout * 65536) / (1 - setting.dropout)
        for step in range(setting.slices):
            at = np.flatnonzero(np.isin(own, setting.slice_buckets(epoch, step)))
            masks = [kept[at, e - n : e] for e, n in zip(ends, setting.hidden)] if setting.dropout else []
            if len(at):
                flat = flat - setting.rate * _gradient(flat, layers, x[at], y[at], masks)[0] / len(at)
    return flat


def fit_sliced(df, *settings, tasks=None):
    members = [Member(PLAIN, 3, s, (1,)) for s in settings]
    rows = dense_net.training_rows(df, "raw", "target", F.col("held"), "id", tasks, members)
    out = dense_net.train(rows, members)
    dense_net.discard_rows(rows)
    return out


def test_slices_of_an_epoch_hold_all_buckets_once():
    setting = Training([4], slices=5)
    dealt = [setting.slice_buckets(3, step) for step in range(5)]
    assert sorted(b for part in dealt for b in part) == list(range(dense_net.BUCKETS))
    assert max(map(len, dealt)) - min(map(len, dealt)) <= 1
    assert dealt != [setting.slice_buckets(4, step) for step in range(5)]
    with pytest.raises(ValueError):
        Training([4], slices=dense_net.BUCKETS + 1)
    with pytest.raises(ValueError):
        Training([4], dropout=1.0)


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_slices_and_dropout_equal_plain_descent(spark, dropout):
    x, y = data(200)
    setting = Training([5, 4], epochs=2, rate=0.3, optimizer="sgd", slices=3, dropout=dropout)
    [fitted] = fit_sliced(rows_of(spark, x, y), setting)
    assert fitted.weights == pytest.approx(plain_descent(x, y, setting), abs=1e-9)
    assert fitted.updates == 6 and len(fitted.history) == 2 and fitted.train_rows == 200


def test_slices_do_not_depend_on_partitions(spark):
    x, y = data(600)
    held, setting, got = np.arange(600) % 5 == 0, Training([6], epochs=2, slices=3, dropout=0.2), []
    for tasks, partitions in ((1, 1), (7, 3), (211, 5)):
        got.append(fit_sliced(rows_of(spark, x, y, held, partitions), setting, tasks=tasks)[0])
    for other in got[1:]:
        assert other.weights == pytest.approx(got[0].weights, abs=1e-9)
        assert other.history == [pytest.approx(h) for h in got[0].history]


def test_an_update_reads_the_buckets_of_its_slice(spark, capsys):
    x, y = data(300)
    members = [Member(PLAIN, 3, Training([4], slices=4))]
    rows = dense_net.training_rows(rows_of(spark, x, y), "raw", "target", F.col("held"), "id", None, members)
    rows.filter(F.col("bucket").isin(members[0].setting.slice_buckets(0, 1))).explain()
    assert "PartitionFilters: [bucket" in capsys.readouterr().out
    dense_net.discard_rows(rows)


def test_networks_with_other_slices_share_passes(spark):
    x, y = data(240)
    held = np.arange(240) % 4 == 0
    settings = [Training([5], epochs=3, slices=4, dropout=0.5), Training([5], epochs=2), Training([7, 3], epochs=4, slices=2, seed=7, dropout=0.2)]
    df = rows_of(spark, x, y, held)
    for setting, joint in zip(settings, fit_sliced(df, *settings)):
        [alone] = fit_sliced(df, setting)
        assert joint.weights == pytest.approx(alone.weights, abs=1e-12)
        assert joint.history == [pytest.approx(h) for h in alone.history] and joint.updates == setting.epochs * setting.slices


def test_scores_use_all_units_and_the_rate_acts(spark):
    x, y = data(160)
    held = np.arange(160) % 4 == 0
    fits = fit_sliced(rows_of(spark, x, y, held), *[Training([6], epochs=2, dropout=d) for d in (0.0, 0.1, 0.3)])
    for fitted in fits:
        n, loss, _ = _score(probabilities(fitted.weights, [3, 6, 3], x[held]), y[held])
        assert fitted.history[-1]["val_loss"] == pytest.approx(loss / n)
    assert np.abs(fits[0].weights - fits[1].weights).max() > 1e-4 < np.abs(fits[1].weights - fits[2].weights).max()


def test_slices_learn_faster_than_whole_tables(spark):
    x, y = data(400)
    sliced, whole = fit_sliced(rows_of(spark, x, y), Training([8], epochs=5, slices=8), Training([8], epochs=5))
    assert sliced.history[-1]["loss"] < 0.8 * whole.history[-1]["loss"]


def test_empty_slices_make_no_update(spark):
    x, y = data(4)
    setting, own = Training([4], epochs=1, slices=48), set(buckets_of(4).tolist())
    [fitted] = fit_sliced(rows_of(spark, x, y), setting)
    assert (fitted.updates, fitted.train_rows) == (sum(bool(set(setting.slice_buckets(e, s)) & own) for e in range(1) for s in range(48)), 4)


def test_a_resumed_training_ends_with_the_same_weights(spark, tmp_path):
    """Cut off after each epoch, with Adam's moments, slices, dropout and a stop rule, and two networks that end at different times."""
    x, y = data(120)
    held = np.arange(120) % 3 == 0
    members = [Member(PLAIN, 3, s, (1,)) for s in (Training([5], epochs=4, slices=2, dropout=0.2), Training([4], epochs=6, rate=2.0, optimizer="sgd", patience=1))]
    rows = dense_net.training_rows(rows_of(spark, x, y, held), "raw", "target", F.col("held"), "id", 2, members)
    whole = dense_net.train(rows, members)
    for _ in range(8):
        parts = dense_net.train(rows, members, str(tmp_path / "state"), most=1)
    for a, b in zip(whole, parts):
        assert b.weights == pytest.approx(a.weights, abs=1e-12) and b.history == [pytest.approx(h) for h in a.history]
        assert (a.best_epoch, a.held_rows, a.train_rows, a.updates) == (b.best_epoch, b.held_rows, b.train_rows, b.updates)
    with pytest.raises(ValueError, match="another"):
        dense_net.train(rows, members[:1], str(tmp_path / "state"))
    with pytest.raises(ValueError, match="another network"):
        dense_net.train(rows, members[::-1], str(tmp_path / "state"))
    dense_net.discard_rows(rows)
