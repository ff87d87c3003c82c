"""The sample table the registered queries run on: one row per order of the given tables.

It has the shape of the sample table in ``schemas``: a three-class label, numeric columns of which some are missing
where an order has no lines, a text column with a sentinel for missing, and a complete text column.

``label`` (order status) is unrelated to the other columns. ``band`` (net value of the lines) can be learned from
them and serves the queries that train.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill.operators.clean import clean
from foldmill.operators.model import Columns

SENTINELS = {"prio": "4-NOT SPECIFIED"}
NUMERIC = ["price", "bal", "qty", "disc"]
CATEGORICAL = ["prio", "seg"]
CLASSES = ["F", "O", "P"]
# Borders of the value bands, near the terciles (fixed values).
BAND_BORDERS = (150_000, 258_000)

LEARNABLE = Columns(key="id", label="band", numeric=["qty", "n_lines", "peak", "bal"], categorical=["prio", "seg"])


# The columns used of the given tables, declared so that opening them reads no file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_returnflag string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are summed per order before the join, so an order with very many lines joins as one row."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.max("l_discount").alias("disc"),
            F.count("*").cast("double").alias("n_lines"),
            F.max("l_extendedprice").alias("peak"),
            F.sum("l_extendedprice").alias("net"),
        )
    )
    low, high = BAND_BORDERS
    net = F.coalesce("net", F.lit(0.0))
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderstatus").alias("label"),
            F.col("o_totalprice").alias("price"),
            F.col("c_acctbal").alias("bal"),
            "qty",
            "disc",
            "n_lines",
            "peak",
            F.col("o_orderpriority").alias("prio"),
            F.col("c_mktsegment").alias("seg"),
            F.when(net < low, "1-small").when(net < high, "2-medium").otherwise("3-large").alias("band"),
        )
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_samples(spark, sf_dir), SENTINELS)
