"""Projections, null handling and schema checks applied before any statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    """The input lacks columns the job needs."""


def sentinel_to_null(df: DataFrame, sentinels: dict[str, str]) -> DataFrame:
    """Replace the text that stands for a missing value by null, per column."""
    present = {c: F.nullif(F.col(c), F.lit(s)) for c, s in sentinels.items() if c in df.columns}
    return df.withColumns(present) if present else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing, but ``avg`` would return NaN for it, so it becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def clean(df: DataFrame, sentinels: dict[str, str]) -> DataFrame:
    """The one cleaning step that training, tuning and scoring all use."""
    return nan_to_null(sentinel_to_null(df, sentinels))


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=cols)


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def features_label_split(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(label)


def numeric_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def select_by_type(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """The excluded columns (key, label), then every numeric column."""
    return df.select(*exclude, *numeric_columns(df.schema, exclude))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise MissingColumnsError(f"the input lacks {', '.join(absent)}")
    return df


def require_target(df: DataFrame, label: str) -> DataFrame:
    if df.select(label).isEmpty():
        raise ValueError(f"target column {label} has no rows")
    return df


def validate_schema(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: whether it is there, and how many of its values are null."""
    present = [c for c in required if c in df.columns]
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present]
    )

    def entry(c: str) -> Column:
        nulls = F.col(f"null_{c}") if c in present else F.lit(None).cast("bigint")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in present).alias("present"),
            F.col("_rows").alias("n_rows"),
            nulls.alias("n_null"),
        )

    return totals.select(F.inline(F.array(*[entry(c) for c in required])))


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; text that is no number becomes null."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def stamp_batch(df: DataFrame, when: datetime, name: str = "prediction_time") -> DataFrame:
    """One UTC time for the whole batch, given by the caller so that reruns agree."""
    if when.tzinfo is None:
        raise ValueError("the batch time needs a time zone")
    return df.withColumn(name, F.to_timestamp(F.lit(when.isoformat())))


def decode_ids(df: DataFrame, encoded: str, name: str = "id") -> DataFrame:
    """One row per id of a JSON array column."""
    ids = F.from_json(F.col(encoded), T.ArrayType(T.LongType()))
    return df.select(*[c for c in df.columns if c != encoded], F.explode(ids).alias(name))
