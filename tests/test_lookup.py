"""The join with a table of unique keys, one of them held by a third of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foldmill.operators.lookup import lookup


@pytest.mark.parametrize("most", [100_000, 0])
def test_heavy_null_and_missing_keys(spark, most):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    rows = spark.range(6_000).select("id", key.alias("k"), F.lit("mine").alias("n"))
    table = rows.groupBy("k").agg(F.count("*").alias("w"), F.sum("id").alias("total")).where("k is null or k <> 'k5'")
    got = lookup(rows, table, ["k"], "w", most)
    assert got.columns == ["id", "k", "n", "total"]
    assert got.count() == 6_000 and got.where("n <> 'mine'").count() == 0
    want = {r["k"]: r["total"] for r in table.collect()}
    assert all(r["total"] == want.get(r["k"]) for r in got.collect())
    assert got.where("k = 'k5' and total is not null").count() == 0 < got.where("k = 'k5'").count()


def test_heavy_rows_are_spread(spark):
    """With 100 light keys and one that holds nearly all rows, no task of the shuffled join has most of them."""
    rows = spark.range(20_000).select(F.when(F.col("id") < 100, F.col("id")).otherwise(-1).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("w"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup(rows, table, ["k"], "w", most=0).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 5_000
