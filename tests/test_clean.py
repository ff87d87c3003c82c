from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from foldmill.operators import clean
from foldmill.schemas import PREDICTION, SAMPLE, SCORING, SENTINELS


def test_sentinel_and_nan_become_null(make):
    df = make([(".", float("nan")), ("MALE", 1.0), (None, None)], "sex string, body_mass_g double")
    assert [tuple(r) for r in clean.clean(df, SENTINELS).collect()] == [(None, None), ("MALE", 1.0), (None, None)]


def test_sentinel_for_an_absent_column_is_ignored(make):
    assert clean.clean(make([(1.0,)], "v double"), SENTINELS).collect()[0]["v"] == 1.0


def test_drop_missing_drops_nan_too(make):
    df = make([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "v double, s string")
    assert [r["s"] for r in clean.drop_missing(df).collect()] == ["a"]


def test_numeric_and_text_columns(make):
    df = make([(1, 2.0, "a", True)], "id long, v double, s string, b boolean")
    assert clean.numeric_columns(df.schema, ("id",)) == ["v"]
    assert clean.text_columns(df.schema) == ["s"]


def test_missing_columns_are_named(make):
    df = make([("x",)], "island string")
    with pytest.raises(clean.MissingColumnsError, match="body_mass_g"):
        clean.require_columns(df, SCORING.fieldNames())


def test_empty_target_is_refused(make):
    with pytest.raises(ValueError, match="no rows"):
        clean.require_target(make([], "species string"), "species")


def test_conform_turns_bad_numbers_into_null(make):
    df = make([("NA", "x", "1.5", "2", "3", "4", "extra")],
              "body_mass_g string, island string, culmen_length_mm string, culmen_depth_mm string, "
              "flipper_length_mm string, sex string, more string")
    out = clean.conform_schema(df, SCORING)
    assert out.schema == SCORING
    assert out.collect()[0]["body_mass_g"] is None and out.collect()[0]["culmen_length_mm"] == 1.5


def test_batch_time_is_utc(make):
    local = datetime(2024, 5, 1, 14, 0, tzinfo=timezone(timedelta(hours=2)))
    row = clean.stamp_batch(make([(1,)], "id int"), local).selectExpr("cast(prediction_time as string) t").collect()[0]
    assert row["t"] == "2024-05-01 12:00:00"
    with pytest.raises(ValueError, match="time zone"):
        clean.stamp_batch(make([(1,)], "id int"), datetime(2024, 5, 1))


def test_schemas_agree():
    assert SAMPLE.fieldNames()[1:] == SCORING.fieldNames() == PREDICTION.fieldNames()[:6]


def test_decode_ids(make):
    df = make([(0, "[3,1]"), (1, "[]")], "fold long, ids string")
    assert [tuple(r) for r in clean.decode_ids(df, "ids").collect()] == [(0, 3), (0, 1)]
