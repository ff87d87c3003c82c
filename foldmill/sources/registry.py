"""Model versions: saved pipelines in directories, and one row per version in a table of small JSON files.

A version is claimed by a file that only one writer can create, so jobs of one name may register at the same time. Its model is saved next and its row last: a claim whose job
ended early is a gap in the numbers and never read.
"""

from __future__ import annotations

import json
import os
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill.schemas import REGISTRY
from foldmill.sources import files


class NoModelError(LookupError):
    """No version is registered under this name."""


def latest(registry: DataFrame) -> DataFrame:
    """The row of the highest version of every name."""
    fields = [c for c in registry.columns if c not in ("name", "version")]
    newest = registry.groupBy("name").agg(
        F.max("version").alias("version"), F.max_by(F.struct(*fields), "version").alias("_row")
    )
    return newest.select("name", "version", "_row.*")


def rows(spark: SparkSession, root: str) -> DataFrame:
    """The registry table, empty before the first registration."""
    try:
        return spark.read.schema(REGISTRY).json(os.path.join(root, "registry"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)


def claim(spark: SparkSession, root: str, name: str) -> int:
    """The next free version of a name, from now on this caller's."""
    found = rows(spark, root).filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (found or 0) + 1
    while not files.create(spark, os.path.join(root, "claims", quote(name, safe=""), str(version)), ""):
        version += 1
    return version


def register(
    spark: SparkSession, root: str, name: str, model: PipelineModel, run_id: str,
    feature_names: list[str], target_classes: list[str], trained_at: datetime,
) -> int:
    """Claim a version, save the model, then its row, so that a row always points at a complete model."""
    version = claim(spark, root, name)
    path = os.path.join(root, "models", quote(name, safe=""), f"version={version}")
    model.write().save(path)
    row = {
        "name": name, "version": version, "path": path, "run_id": run_id, "feature_names": list(feature_names),
        "target_classes": [str(c) for c in target_classes], "trained_at": trained_at.isoformat(),
    }
    files.create(spark, os.path.join(root, "registry", f"{quote(name, safe='')}-{version}.json"), json.dumps(row))
    return version


def load_latest(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, dict]:
    """The newest model of that name with its metadata."""
    row = latest(rows(spark, root).filter(F.col("name") == name)).first()
    if row is None:
        raise NoModelError(f"no model registered as {name}")
    return PipelineModel.load(row["path"]), row.asDict()
