"""Batch scoring with a registered model, and the log of predictions."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmill.operators import clean, evaluate, model
from foldmill.sources import files, tables


def score_batch(
    fitted: PipelineModel, df: DataFrame, required: Sequence[str], classes: Sequence[str], when: datetime,
    sentinels: dict[str, str] | None = None,
) -> DataFrame:
    """Check and clean the batch as training did, then add prediction, confidence and the batch time."""
    clean.require_columns(df, list(required))
    ready = clean.clean(df, sentinels or {})
    return clean.stamp_batch(model.predict(fitted, ready, classes).drop("probability"), when)


def attach_predictions(inputs: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Bring predictions scored elsewhere back to their inputs."""
    return inputs.join(predictions.select(key, "prediction", "confidence"), key)


def index_to_label(df: DataFrame, index: str, classes: Sequence[str], name: str = "prediction") -> DataFrame:
    return df.withColumn(name, F.try_element_at(evaluate.listed(classes), (F.col(index) + 1).cast("int")))


PREDICTED = [("prediction", T.StringType()), ("confidence", T.DoubleType()), ("prediction_time", T.TimestampType())]


def log_rows(scored: DataFrame, inputs: Sequence[T.StructField]) -> DataFrame:
    """A batch as the log takes it: the declared inputs and the predictions in their declared types, every other column as text,
    so that batches of any origin can be read together. Declared inputs that a batch lacks are left out and read as null."""
    declared = [f for f in inputs if f.name in scored.columns] + [T.StructField(n, t) for n, t in PREDICTED]
    known = clean.conform_schema(scored.select(*[f.name for f in declared]), T.StructType(declared))
    names = {f.name for f in declared}
    others = [c for c in scored.columns if c not in names]
    if not others:
        return known
    every = T.StructType([*declared, *[T.StructField(c, T.StringType()) for c in others]])
    return clean.conform_schema(scored, every)


def _folder(batch: str) -> str:
    return f"b{batch.encode().hex()}"


def write_attempt(rows: DataFrame, path: str, batch: str) -> str:
    """Write a batch to a folder of its own; it is not in the log before :func:`commit`."""
    attempt = f"a{uuid.uuid4().hex}"
    tables.write_path(rows, os.path.join(path, "batches", f"batch={_folder(batch)}", f"attempt={attempt}"))
    return attempt


def commit(spark, path: str, batch: str, attempt: str) -> bool:
    """Make an attempt the batch's one; False if another one is."""
    marker = {"batch": _folder(batch), "attempt": attempt}
    return files.create(spark, os.path.join(path, "commits", f"{_folder(batch)}.json"), json.dumps(marker))


def capture(
    scored: DataFrame, path: str, inputs: Sequence[T.StructField], enabled: bool = True, batch: str | None = None
) -> DataFrame:
    """Add a scored batch to the log and return the logged rows; without ``enabled`` the batch comes back as it is.

    ``batch`` is the caller's name for the batch: however often it is captured, by retries or by two jobs at once, it is in the log
    once, as first committed. Without a name each call is a batch of its own. Rows are written once and read back, so a batch is scored once, and one that is
    in the log already is not scored at all.
    """
    if not enabled:
        return scored
    spark, batch = scored.sparkSession, batch or uuid.uuid4().hex
    rows = log_rows(scored, inputs)
    if not files.exists(spark, os.path.join(path, "commits", f"{_folder(batch)}.json")):
        commit(spark, path, batch, write_attempt(rows, path, batch))
    kept = spark.read.schema(COMMITS).json(os.path.join(path, "commits", f"{_folder(batch)}.json")).first()
    folder = os.path.join(path, "batches", f"batch={kept['batch']}", f"attempt={kept['attempt']}")
    return tables.read_path(spark, folder, rows.schema)


COMMITS = "batch string, attempt string"


def read_log(spark, path: str) -> DataFrame:
    """All committed batches under the union of their columns; what failed or lost attempts left is not read."""
    done = spark.read.schema(COMMITS).json(os.path.join(path, "commits"))
    return tables.read_merged(spark, os.path.join(path, "batches")).join(done, ["batch", "attempt"], "left_semi").drop("batch", "attempt")
