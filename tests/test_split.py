from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foldmill.operators import split
from foldmill.operators.keys import with_row_key
from foldmill.operators.rank import global_rank


def sizes(df, name):
    return {r[0]: r[1] for r in df.groupBy(name).count().collect()}


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 11, 1003])
def test_fold_sizes_differ_by_at_most_one(spark, rows):
    found = sizes(split.kfold(spark.range(rows), "id", 5), "fold")
    assert sum(found.values()) == rows
    expected = [rows // 5 + (f < rows % 5) for f in range(5)]
    assert [found.get(f, 0) for f in range(5)] == expected


def test_folds_do_not_depend_on_partitioning(spark):
    def folds(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        df = spark.range(2000).repartition(partitions)
        return sorted((r["id"], r["fold"]) for r in split.kfold(df, "id", 5).collect())

    try:
        first = folds(2)
        assert folds(7) == first and folds(64) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_folds_change_with_the_seed(spark):
    df = spark.range(500)
    assert split.kfold(df, "id", 5, 1).collect() != split.kfold(df, "id", 5, 2).collect()


def test_train_and_test_rows_cover_everything_once(spark):
    folded = split.kfold(spark.range(101), "id", 5)
    for fold in range(5):
        train = {r["id"] for r in split.train_rows(folded, fold).collect()}
        test = {r["id"] for r in split.test_rows(folded, fold).collect()}
        assert not train & test and train | test == set(range(101))


def test_text_keys(spark):
    df = spark.range(200).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    assert set(sizes(split.kfold(df, "key", 4), "fold").values()) == {50}


def test_assigning_folds_needs_no_shuffle(spark, capsys):
    split.kfold(spark.range(1000), "id", 5).explain()
    assert "Exchange" not in capsys.readouterr().out


REPEATS = [2, 50, 5_000, 9_000, 12_000]


def with_repeats(spark, times, rows=20_000):
    """``rows`` rows of which ``times`` share one key."""
    return spark.range(rows).select(F.when(F.col("id") < times, F.lit(-1)).otherwise(F.col("id")).alias("id"), F.col("id").alias("v"))


@pytest.mark.parametrize("times", REPEATS)
def test_rows_of_one_key_share_a_fold(spark, times):
    folded = split.kfold(with_repeats(spark, times), "id", 5).cache()
    assert folded.filter("id = -1").select("fold").distinct().count() == 1
    found = sizes(folded, "fold")
    assert sum(found.values()) == 20_000 and max(found.values()) <= max(4_000, times) + 4_000
    parts = split.train_val_test(with_repeats(spark, times), "id").filter("id = -1")
    assert parts.select("part").distinct().count() == 1
    folded.unpersist()


def test_one_key_only(spark):
    assert len(sizes(split.kfold(spark.range(100).withColumn("id", F.lit(7)), "id", 5), "fold")) == 1


@pytest.mark.parametrize("times", REPEATS)
def test_positions_of_a_repeated_key_are_refused(spark, times):
    with pytest.raises(Exception, match="RepeatedKey"):
        global_rank(with_repeats(spark, times), "id", 42).select("position").collect()


def test_every_key_twice(spark):
    twice = spark.range(500).unionByName(spark.range(500))
    assert split.kfold(twice, "id", 5).groupBy("id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    with pytest.raises(Exception, match="RepeatedKey"):
        global_rank(twice, "id", 42).select("position").collect()


def test_rank_of_an_empty_table(spark):
    assert global_rank(spark.range(0), "id", 42).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 2, 10, 17, 1000])
def test_three_way_split_sizes(spark, rows):
    found = sizes(split.train_val_test(spark.range(rows), "id"), "part")
    held_out = -(-3 * rows // 10)
    test = -(-held_out // 2)
    assert found.get("test", 0) == test and found.get("val", 0) == held_out - test
    assert found.get("train", 0) == rows - held_out


def test_holdout_is_the_tail_of_the_order(spark):
    rows = [r["is_holdout"] for r in split.stable_shuffle(split.holdout_tail(spark.range(50), "id"), "id").collect()]
    assert rows == [False] * 40 + [True] * 10


def test_global_rank_is_the_sorted_position(spark):
    df = spark.range(3000)
    ranked = [r["id"] for r in global_rank(df, "id", 42).orderBy("position").collect()]
    assert ranked == [r["id"] for r in split.stable_shuffle(df, "id").collect()]
    assert [r[0] for r in global_rank(df, "id", 42).select("position").orderBy("position").collect()] == list(range(3000))


def test_samples_are_the_first_of_the_order(spark):
    df = spark.range(2000)
    order = [r["id"] for r in split.stable_shuffle(df, "id").collect()]
    for n in (0, 1, 300, 1999, 5000):
        assert {r["id"] for r in split.sample_n(df, "id", n).collect()} == set(order[:n])


def test_id_lists_hold_every_id_in_each_fold(spark):
    folded = split.kfold(spark.range(90), "id", 3)
    lists = split.fold_id_lists(folded, "id", 3, pieces=4).collect()
    assert max(len(r["ids"]) for r in lists) < 30
    for fold in range(3):
        ids = [i for r in lists if r["fold"] == fold for i in r["ids"]]
        assert sorted(ids) == list(range(90))


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_row_keys_with_many_copies(spark, piece):
    """A third of the rows are one and the same; another part differs only by null."""
    rows = [("a", 1.0)] * 40 + [(None, 1.0), (None, None), ("", None)] + [(f"x{i}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, v double")
    keyed = with_row_key(df, piece=piece)
    assert keyed.count() == len(rows)
    assert keyed.select("row_key").distinct().count() == len(rows)
    assert sorted(map(repr, keyed.select("s", "v").collect())) == sorted(map(repr, df.collect()))


def test_row_keys_do_not_depend_on_partitioning(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("v"))
    keys = [sorted(r[0] for r in with_row_key(df.repartition(n)).select("row_key").collect()) for n in (1, 9)]
    assert keys[0] == keys[1]


def test_rows_by_repeated_ids(spark):
    ids = spark.range(1000).select((F.col("id") % 3).alias("id"))
    assert sorted(r["id"] for r in split.rows_by_id_list(spark.range(10), ids, "id").collect()) == [0, 1, 2]


def test_many_copies_are_spread_over_tasks(spark):
    keyed = with_row_key(spark.range(200_000).select(F.lit("x").alias("v")), piece=1000)
    per_task = [r["count"] for r in keyed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == 200_000 and max(per_task) < 60_000


def test_small_and_large_samples_agree(spark, make, monkeypatch):
    """With repeated and null keys: a key is taken or left whole, also where the border falls among its rows."""
    df = make([(None if i % 7 == 0 else i % 11, i) for i in range(60)], "k long, v long")
    for n in (0, 1, 4, 9, 23, 59, 60, 100):
        small = sorted(r["v"] for r in split.sample_n(df, "k", n).collect())
        monkeypatch.setattr(split, "SMALL_SAMPLE", -1)
        large = sorted(r["v"] for r in split.sample_n(df, "k", n).collect())
        monkeypatch.undo()
        assert len(small) <= n or n >= 60
        if n:
            assert small == large
