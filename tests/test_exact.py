"""Exact moments: the same bits however rows are dealt, equal to sums of fractions."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest

from foldmill.operators import exact, features, split


def plain(values):
    known = [Fraction(v) for v in values if v is not None and not math.isnan(v)]
    total = sum(known)
    return len(known), float(total / len(known)), float(sum(v * v for v in known) - total * total / len(known)), total


def awkward():
    rng = random.Random(3)
    values = [rng.gauss(0, 1) * 10 ** rng.randint(-12, 12) for _ in range(400)]
    values += [1e16, 1.0, -1e16, 5e-324, -5e-324, 2.2e-308, 0.0, -0.0, 2.0**60, math.nextafter(2.0, 0), math.nextafter(8.0, 9), 0.1, 0.1, 0.1]
    values += [float(2**k) for k in range(-40, 40)]
    return values + [None, float("nan")] + [0.3] * 300  # a hot value


def moments(df, by=()):
    return exact.moments(exact.cells(df, ["v"], by), by)


@pytest.mark.parametrize("tasks", [1, 7, 211])
def test_equals_fractions_at_any_partitioning(spark, tasks):
    values = awkward()
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(tasks)
    n, mean, m2, _ = plain(values)
    got = moments(df).first()
    assert (got.n_rows, got.n, got.mu, got.m2) == (len(values), n, mean, m2)


def test_largest_and_smallest_doubles(make):
    values = [1.7976931348623157e308, -1.7976931348623157e308, 5e-324]
    got = moments(make([(v,) for v in values], "v double")).first()
    assert (got.mu, got.m2, got.units) == (float(Fraction(5e-324) / 3), math.inf, None)


def test_units_hold_the_whole_sum(make):
    values = [0.1, 0.2, 1e10, -3.75]
    got = moments(make([(v,) for v in values], "v double")).first()
    assert Fraction(int(got.units), 2**60) == plain(values)[3]


def test_nulls_infinities_and_empty_tables(make):
    inf = math.inf
    rows = [("none", None), ("none", float("nan")), ("up", inf), ("up", 1.0), ("both", inf), ("both", -inf), ("down", -inf), (None, 2.0)]
    got = {r.g: r for r in moments(make(rows, "g string, v double"), ["g"]).collect()}
    assert (got["none"].n_rows, got["none"].n, got["none"].mu, got["none"].m2) == (2, 0, None, None)
    assert [(got[g].mu, got[g].m2) for g in ("up", "down", "both")] == [(inf, None), (-inf, None), (None, None)]
    assert (got[None].n, got[None].mu, got[None].m2) == (1, 2.0, 0.0)
    assert moments(make([], "v double")).count() == 0


def test_plans_have_equal_bits(spark, make):
    rows = [(i, v, v) for i, v in enumerate(awkward())]
    bits = lambda plan: [struct.pack("<d", x) for x in (plan.means["v"], plan.deviations["v"])]
    seen, per_fold = [], []
    for tasks in (1, 7, 211):
        df = make(rows, "id long, v double, w double").repartition(tasks)
        seen.append(bits(features.fit_features(df, ["v"], [], exactly=True)))
        plans = features.fit_fold_features(split.kfold_by_hash(df, "id", 5), 5, ["v"], [], exactly=True)
        per_fold.append([bits(plans[f]) for f in range(5)])
    assert seen[0] == seen[1] == seen[2] and per_fold[0] == per_fold[1] == per_fold[2]
    plain_plan = features.fit_features(make(rows, "id long, v double, w double"), ["v"], [])
    assert features.fit_features(make(rows, "id long, v double, w double"), ["v"], [], exactly=True).means["v"] == pytest.approx(plain_plan.means["v"], rel=1e-9)
