"""From a CSV file to a table and its folds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill.operators import clean, keys, split
from foldmill.schemas import RUN_INGEST, SAMPLE, SENTINELS
from foldmill.sources import runs, tables


def ingest(
    spark: SparkSession, csv_path: str, table_path: str, when: datetime,
    runs_path: str | None = None, snapshot_path: str | None = None,
) -> DataFrame:
    """Read, clean, key and store the samples; record path and size, and on request a JSON snapshot.

    The source has no key, so each row gets one from its content and its number among equal rows.
    """
    rows = clean.clean(tables.read_csv(spark, csv_path, SAMPLE), SENTINELS)
    tables.write_path(keys.with_row_key(rows), table_path)
    stored = tables.read_path(spark, table_path)
    if snapshot_path:
        tables.write_snapshot(stored, snapshot_path)
    if runs_path:
        run = runs.Run(RUN_INGEST, when)
        run.param("dataset_path", csv_path)
        run.metric("data_size", stored.count())
        runs.append_runs(spark, runs_path, [run])
    return stored


def make_folds(spark: SparkSession, table_path: str, folds_path: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Store the ``(row_key, fold)`` table of the samples."""
    assigned = split.kfold(tables.read_path(spark, table_path), "row_key", folds, seed)
    tables.write_path(assigned.select("row_key", "fold"), folds_path)
    return tables.read_path(spark, folds_path)


def id_lists(fold_table: DataFrame, folds: int = 5) -> DataFrame:
    """The fold table as lists of train and test keys, in pieces of bounded size."""
    pieces = split.list_pieces(fold_table.agg(F.count("*")).first()[0], folds)
    return split.fold_id_lists(fold_table, "row_key", folds, pieces)
