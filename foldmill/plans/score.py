"""Score a batch with the newest registered model and log what was predicted."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from foldmill.operators import score as scoring
from foldmill.schemas import SCORING, SENTINELS
from foldmill.sources import registry


class BatchScorer:
    """The newest version of a model, loaded once and used for any number of batches."""

    def __init__(
        self, spark: SparkSession, registry_root: str, name: str, log_path: str,
        inputs: StructType | None = None, sentinels: dict[str, str] | None = None, capture: bool = True,
    ):
        self.model, self.version = registry.load_latest(spark, registry_root, name)
        self.classes = self.version["target_classes"]
        self.inputs = inputs or SCORING
        self.required = self.inputs.fieldNames()
        self.sentinels = SENTINELS if sentinels is None else sentinels
        self.log_path, self.capture = log_path, capture

    def score(self, batch: DataFrame, when: datetime, capture: bool | None = None, batch_id: str | None = None) -> DataFrame:
        """The batch with predictions, read back from the log if it was logged; ``capture`` overrides the scorer's own setting for this call. A retry that
        gives the same ``batch_id`` logs nothing twice."""
        scored = scoring.score_batch(self.model, batch, self.required, self.classes, when, self.sentinels)
        wanted = self.capture if capture is None else capture
        return scoring.capture(scored, self.log_path, self.inputs, wanted, batch_id)
