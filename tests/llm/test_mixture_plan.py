"""What the mixture does to whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldmill.llm import mixing


def test_texts_are_not_sorted_when_they_are_repeated(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = mixing.mixed(docs)
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        assert rows.count() == sum(r["copies"] for r in mixing.mixture(docs).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    line = next(x for x in plan.splitlines() if "Join" in x and "__rid" in x)
    assert "ShuffledHashJoin" in line
