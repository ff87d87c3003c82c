from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldmill.operators import features, split, stats


def vectors(plan, df):
    out = plan.pipeline(df.sparkSession).transform(df)
    return [list(r[0]) for r in out.select(vector_to_array("features")).collect()]


def test_imputed_deviation_counts_all_rows(make):
    df = make([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    plan = features.fit_features(df, ["v"], [])
    assert plan.means["v"] == 2.0
    assert plan.deviations["v"] == pytest.approx((2 / 4) ** 0.5)
    assert vectors(plan, df) == [[pytest.approx(-(2**0.5))], [pytest.approx(2**0.5)], [0.0], [0.0]]


def test_decimal_and_integer_columns(spark):
    df = spark.sql("select * from values (1, 1.50), (3, 2.50), (null, null) as t(i, d)")
    plan = features.fit_features(df, ["i", "d"], [])
    assert plan.means == {"i": 2.0, "d": 2.0}
    assert vectors(plan, df)[2] == [0.0, 0.0]


def test_constant_column_is_centred_only(make):
    df = make([(5.0,), (5.0,)], "v double")
    assert vectors(features.fit_features(df, ["v"], []), df) == [[0.0], [0.0]]


def test_all_null_columns_are_left_out(make):
    df = make([(1.0, None, "a", None), (2.0, None, "b", None)], "v double, w double, s string, t string")
    plan = features.fit_features(df, ["v", "w"], ["s", "t"])
    assert plan.names() == ["v", "s_a", "s_b"]


def test_mode_is_the_lowest_on_ties(make):
    df = make([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    plan = features.fit_features(df, [], ["s"])
    assert plan.fills["s"] == "a"
    assert stats.most_frequent(stats.category_counts(df, ["s"])).collect()[0]["mode"] == "a"


def test_unseen_is_zero_and_null_takes_the_mode(make):
    plan = features.fit_features(make([("a",), ("b",), ("b",)], "s string"), [], ["s"])
    assert vectors(plan, make([("a",), ("zzz",), (None,)], "s string")) == [[1.0, 0.0], [0.0, 0.0], [0.0, 1.0]]


def test_drop_first_keeps_unseen_as_zero(make):
    df = make([("a",), ("b",), ("c",)], "s string")
    plan = features.fit_features(df, [], ["s"], drop_first=True)
    assert plan.names() == ["s_b", "s_c"]
    assert vectors(plan, make([("a",), ("b",), ("q",)], "s string")) == [[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]


def test_one_hot_rows_sum_to_one_for_known_values(make):
    df = make([(v,) for v in "abcab"], "s string")
    assert all(sum(v) == 1.0 for v in vectors(features.fit_features(df, [], ["s"]), df))


def fold_table(spark, shift=0.0):
    df = spark.range(300).select(
        "id", (F.col("id") % 17).cast("double").alias("v"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("s"),
    )
    folded = split.kfold(df, "id", 5)
    return folded.withColumn("v", F.when(F.col("fold") == 1, F.col("v") + shift).otherwise(F.col("v")))


def test_fold_plans_equal_direct_fits(spark):
    folded = fold_table(spark)
    plans = features.fit_fold_features(folded, 5, ["v"], ["s"])
    for fold in range(5):
        direct = features.fit_features(split.train_rows(folded, fold), ["v"], ["s"])
        assert plans[fold].means["v"] == pytest.approx(direct.means["v"])
        assert plans[fold].deviations["v"] == pytest.approx(direct.deviations["v"])
        assert (plans[fold].fills, plans[fold].vocabulary) == (direct.fills, direct.vocabulary)


def test_test_rows_do_not_leak_into_train_statistics(spark):
    before = features.fit_fold_features(fold_table(spark), 5, ["v"], ["s"])
    after = features.fit_fold_features(fold_table(spark, shift=1e6), 5, ["v"], ["s"])
    assert after[1].means == pytest.approx(before[1].means)
    assert after[0].means["v"] > before[0].means["v"] + 1000


def test_category_seen_in_one_fold_only(spark):
    folded = fold_table(spark).withColumn("s", F.when(F.col("fold") == 2, F.lit("rare")).otherwise(F.col("s")))
    plans = features.fit_fold_features(folded, 5, ["v"], ["s"])
    assert "rare" not in plans[2].vocabulary["s"] and "rare" in plans[0].vocabulary["s"]


def test_saved_stages_give_the_same_vectors(spark, tmp_path):
    df = fold_table(spark)
    stages = features.fit_features(df, ["v"], ["s"]).pipeline(spark)
    stages.write().save(str(tmp_path / "features"))
    loaded = PipelineModel.load(str(tmp_path / "features"))
    cols = ["id", vector_to_array("features").alias("a")]
    assert loaded.transform(df).select(*cols).orderBy("id").collect() == stages.transform(df).select(*cols).orderBy("id").collect()


def test_unknown_label_fails(make):
    df = make([("a",), ("b",)], "y string")
    assert [r[0] for r in df.select(features.target_ordinal("y", ["a", "b"])).collect()] == [0, 1]
    with pytest.raises(Exception, match="unknown y"):
        df.select(features.target_ordinal("y", ["a"])).collect()


def test_any_number_of_categories(spark):
    """150,000 values of one column, two columns of 60,000, and as many classes."""
    df = spark.range(150_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("s"))
    ranked = stats.categories(df, ["s"])
    assert ranked.count() == 150_000 and ranked.agg(F.max("idx")).first()[0] == 149_999
    classes = stats.class_list(df, "s")
    assert len(classes) == 150_000 == len(features.fit_features(df, [], ["s"]).vocabulary["s"])
    two = spark.range(60_000).select(F.concat(F.lit("a"), F.col("id")).alias("s"), F.concat(F.lit("b"), F.col("id")).alias("t"))
    assert len(features.fit_features(two, [], ["s", "t"]).names()) == 120_000
    got = df.limit(3).select("s", features.target_ordinal("s", classes).alias("t")).collect()
    assert [classes[r["t"]] for r in got] == [r["s"] for r in got]


def test_describe_of_an_empty_and_a_single_row(make):
    empty = {r["column_name"]: r for r in stats.describe(make([], "v double, s string")).collect()}
    assert empty["v"]["n"] == 0 and empty["v"]["mean"] is None
    one = {r["column_name"]: r for r in stats.describe(make([(2.0, "x")], "v double, s string")).collect()}
    assert one["v"]["mean"] == 2.0 and one["v"]["sd"] is None and one["s"]["max_text"] == "x"


@pytest.mark.parametrize("drop_first", [False, True])
def test_view_gives_the_same_vectors_as_the_stages(spark, drop_first):
    """Also with missing values, values no plan knows, a value only another plan knows, and a constant column."""
    train = spark.createDataFrame(
        [(1.0, 5.0, None, "a", "x"), (None, 5.0, None, "b", None), (4.0, 5.0, None, "b", None)],
        "v double, k double, gone double, s string, t string")
    other = spark.createDataFrame([(1.0, 1.0, 1.0, "c", "z")], train.schema)
    rows = train.unionByName(other).union(spark.createDataFrame([(float("nan"), 7.0, 2.0, "zzz", "x"), (2.0, 1.0, None, None, "q")], train.schema))
    numeric, texts = ["v", "k", "gone"], ["s", "t"]
    plan = features.fit_features(train, numeric, texts, drop_first=drop_first)
    vocabulary = features.union_vocabulary([plan, features.fit_features(other, numeric, texts)])
    raw = features.raw_rows(rows, numeric, texts, vocabulary)
    view = features.view_of(plan, vocabulary)
    got = view.vectors(np.array([r["raw"] for r in raw.select("raw").collect()]))
    assert got == pytest.approx(np.array(vectors(plan, rows)))
    assert view.width == len(plan.names())
