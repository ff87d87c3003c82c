"""Category dictionaries as tables: every distinct value of some text columns with dense codes, numbered on the executors.

A dictionary has a row for each column and value, however many there are; the driver never holds values. ``codes`` has one entry per plan (a fold's train rows, say): the
value's place among the plan's values in their order, or -1 if the plan has not seen it. Rows are coded by an equi-join (see ``lookup``), so a
value that a third of the rows hold fills no partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmill.operators.lookup import lookup
from foldmill.session import new_folder, remove_folder

#: What a coded column holds where the value is unknown or null.
UNKNOWN, MISSING = -1, -2
SCHEMA = "column_name string, value string, n bigint, codes array<int>"


@dataclass
class Dictionary:
    """A stored dictionary; ``widths[p][column]`` is the number of values that plan ``p`` has seen."""

    path: str
    widths: list[dict[str, int]]
    _values: dict[int, dict[str, list[str]]] = field(default_factory=dict, repr=False)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self.path)

    def values(self, spark: SparkSession, plan: int) -> dict[str, list[str]]:
        """The values of one plan by column, in order, on the driver: for reports on short dictionaries."""
        if plan not in self._values:
            found: dict[str, list[str]] = {}
            rows = self.table(spark).select("column_name", "value", F.col("codes")[plan].alias("code")).where("code >= 0")
            for r in sorted(rows.collect(), key=lambda r: (r["column_name"], r["code"])):
                found.setdefault(r["column_name"], []).append(r["value"])
            self._values[plan] = found
        return self._values[plan]

    def code_of(self, spark: SparkSession, plan: int, values: dict[str, str]) -> dict[str, int]:
        """The codes of one value a column."""
        wanted = spark.createDataFrame(list(values.items()), "column_name string, value string")
        rows = self.table(spark).join(F.broadcast(wanted), ["column_name", "value"]).select("column_name", F.col("codes")[plan].alias("code"))
        return {r["column_name"]: r["code"] for r in rows.collect()}


def build(counts: DataFrame, plans: int = 1) -> Dictionary:
    """From counts (fold, column_name, value, n): ``fold`` is the plan that the count belongs to.

    Values are put in order by a range shuffle. Each task numbers its own within a column, for all plans at once; what the
    tasks before it hold of the column is added by a join with a row for each task and column.
    """
    spark = counts.sparkSession
    seen = F.transform(F.sequence(F.lit(0), F.lit(plans - 1)), lambda p: F.array_contains("folds", p.cast("bigint")).cast("int"))
    values = counts.groupBy("column_name", "value").agg(F.sum("n").alias("n"), F.collect_set(F.col("fold").cast("bigint")).alias("folds"))
    values = values.select("column_name", "value", "n", seen.alias("seen"))
    path, numbered = new_folder(spark, "dictionary"), new_folder(spark, "numbered")

    def number(batches):
        from pyspark import TaskContext

        task, column, before = TaskContext.get().partitionId(), None, np.zeros(plans, np.int64)
        for batch in batches:
            names = batch.column(0).to_pylist()
            marks = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(names), plans)
            local = np.empty((len(names), plans), np.int32)
            for at, name in enumerate(names):
                if name != column:
                    column, before = name, np.zeros(plans, np.int64)
                local[at] = np.where(marks[at] > 0, before, UNKNOWN)
                before = before + marks[at]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, local.size + 1, plans, dtype=np.int32)), pa.array(local.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists, pa.array(np.full(len(names), task, np.int32))], names=["column_name", "value", "n", "codes", "task"])

    ordered = values.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value")
    ordered.mapInArrow(number, SCHEMA + ", task int").write.parquet(numbered)
    rows = spark.read.schema(SCHEMA + ", task int").parquet(numbered)
    known = [F.count_if(F.col("codes")[p] >= 0).cast("int").alias(f"k{p}") for p in range(plans)]
    sizes = rows.groupBy("column_name", "task").agg(*known)
    earlier = Window.partitionBy("column_name").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column_name", "task", F.array(*[F.coalesce(F.sum(f"k{p}").over(earlier), F.lit(0)).cast("int") for p in range(plans)]).alias("starts"))
    codes = F.zip_with("codes", "starts", lambda c, s: F.when(c >= 0, c + s).otherwise(F.lit(UNKNOWN)))
    rows.join(starts, ["column_name", "task"]).select("column_name", "value", "n", codes.alias("codes")).write.parquet(path)
    widths = [{} for _ in range(plans)]
    for r in sizes.groupBy("column_name").agg(*[F.sum(f"k{p}").alias(f"k{p}") for p in range(plans)]).collect():  # a row a column
        for p in range(plans):
            if r[f"k{p}"]:
                widths[p][r["column_name"]] = int(r[f"k{p}"])
    remove_folder(spark, numbered)
    return Dictionary(path, widths)


def encode(df: DataFrame, table: DataFrame, columns: Sequence[str], names: Sequence[str], plans: int = 1) -> DataFrame:
    """Add for each column an array of its codes in all plans: ``UNKNOWN`` for values the dictionary lacks, ``MISSING`` for null."""
    for column, name in zip(columns, names):
        own = table.where(F.col("column_name") == column).select(F.col("value").alias("_value"), "n", F.col("codes").alias("_codes"))
        df = lookup(df.withColumn("_value", F.col(column).cast("string")), own, ["_value"], "n")
        nothing = F.array_repeat(F.when(F.col("_value").isNull(), F.lit(MISSING)).otherwise(F.lit(UNKNOWN)), plans)
        df = df.withColumn(name, F.coalesce("_codes", nothing)).drop("_value", "_codes")
    return df
