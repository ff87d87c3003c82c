"""Aggregates that feed the fitted steps and the reports; each is one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.operators.clean import numeric_columns, text_columns


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def describe(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Count, mean, sample deviation and range of every number and text column, one row per column."""
    numbers, texts = numeric_columns(df.schema, exclude), text_columns(df.schema, exclude)
    aggs = []
    for c in numbers + texts:
        aggs += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    for c in numbers:
        aggs += [F.avg(c).alias(f"mu_{c}"), F.stddev(c).alias(f"sd_{c}")]
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def entry(c: str, is_number: bool):
        return F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{c}").alias("n"),
            (F.col(f"mu_{c}") if is_number else no_number).alias("mean"),
            (F.col(f"sd_{c}") if is_number else no_number).alias("sd"),
            (F.col(f"lo_{c}").cast("double") if is_number else no_number).alias("min_number"),
            (F.col(f"hi_{c}").cast("double") if is_number else no_number).alias("max_number"),
            (no_text if is_number else F.col(f"lo_{c}")).alias("min_text"),
            (no_text if is_number else F.col(f"hi_{c}")).alias("max_text"),
        )

    rows = [entry(c, True) for c in numbers] + [entry(c, False) for c in texts]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, count of values, mean and sum of squared deviations per group and column; NaN is no value."""
    aggs = [F.count("*").alias("_rows")]
    for c in cols:
        number = F.col(c).cast("double")
        known = F.when(~F.isnan(number), number)
        aggs += [
            F.count(known).alias(f"n_{c}"),
            F.avg(known).alias(f"mu_{c}"),
            (F.var_pop(known) * F.count(known)).alias(f"m2_{c}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(f"n_{c}").alias("n"),
            F.col(f"mu_{c}").alias("mu"),
            F.col(f"m2_{c}").alias("m2"),
        )
        for c in cols
    ]
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def _fold_list(folds: int):
    return F.array(*[F.lit(f).cast("bigint") for f in range(folds)])


def train_moments(per_fold: DataFrame, folds: int) -> DataFrame:
    """Moments of the train rows of every fold: all folds but one, merged.

    ``per_fold`` holds a row per fold and column, so the table is read once rather than once per fold.
    """
    others = per_fold.withColumn("test_fold", F.explode(_fold_list(folds))).filter("fold <> test_fold")
    group = Window.partitionBy("test_fold", "column_name")
    mean = F.sum(F.col("n") * F.col("mu")).over(group) / F.nullif(F.sum("n").over(group), F.lit(0))
    return (
        others.withColumn("_mean", mean)
        .groupBy("test_fold", "column_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n").alias("n"),
            F.max("_mean").alias("mu"),
            F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mu") - F.col("_mean"), 2)).alias("m2"),
        )
        .withColumnRenamed("test_fold", "fold")
    )


def mean_and_deviation(moments_table: DataFrame, imputed: bool) -> DataFrame:
    """Mean and population deviation per row of a moments table.

    With mean imputation the missing values sit on the mean: they add nothing to the squared deviations
    but count in the denominator.
    """
    size = F.col("n_rows") if imputed else F.col("n")
    return moments_table.withColumn("sd", F.sqrt(F.col("m2") / F.nullif(size, F.lit(0)))).drop("m2")


def category_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each non-null value of several columns, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ]
    long = df.select(*by, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return long.groupBy(*by, "column_name", "value").agg(F.count("*").alias("n"))


def train_category_counts(per_fold: DataFrame, folds: int) -> DataFrame:
    """Counts among the train rows of every fold: the total less the fold's own."""
    totals = per_fold.groupBy("column_name", "value").agg(
        F.sum("n").alias("_total"),
        # at most one entry per fold
        F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("_own"),
    )
    return (
        totals.withColumn("fold", F.explode(_fold_list(folds)))
        .withColumn("n", F.col("_total") - F.coalesce(F.try_element_at("_own", F.col("fold")), F.lit(0)))
        .filter("n > 0")
        .select("fold", "column_name", "value", "n")
    )


def most_frequent(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent value per column, the lowest one on ties."""
    rank = F.struct((-F.col("n")).alias("n"), F.col("value"))
    return counts.groupBy(*by, "column_name").agg(F.min_by("value", rank).alias("mode"))


def class_list(df: DataFrame, label: str) -> list:
    """The sorted distinct labels: the names of a classifier's outputs."""
    return sorted(r[0] for r in df.select(label).filter(F.col(label).isNotNull()).distinct().collect())


def categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column with their place in sorted order.

    Values are made distinct before they are ranked, and stay on the executors.
    """
    order = Window.partitionBy("column_name").orderBy("value")
    counts = category_counts(df, cols).select("column_name", "value")
    return counts.withColumn("idx", (F.row_number().over(order) - 1).cast("bigint"))
