"""Table schemas. Names, types and order of the sample and prediction tables are fixed values."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

LABEL = "species"
SENTINELS = {"sex": "."}
NUMERIC = ["culmen_length_mm", "culmen_depth_mm", "flipper_length_mm", "body_mass_g"]
CATEGORICAL = ["island", "sex"]

_INPUTS = [
    ("island", StringType()),
    ("culmen_length_mm", DoubleType()),
    ("culmen_depth_mm", DoubleType()),
    ("flipper_length_mm", DoubleType()),
    ("body_mass_g", DoubleType()),
    ("sex", StringType()),
]


def _table(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


SAMPLE = _table(("species", StringType()), *_INPUTS)
SCORING = _table(*_INPUTS)
PREDICTION = _table(
    *_INPUTS, ("prediction", StringType()), ("confidence", DoubleType()), ("prediction_time", TimestampType())
)

# Names of the recorded runs (fixed values).
RUN_INGEST = "start_pipeline"
RUN_CROSS_VALIDATION = "cross-validation"
RUN_FOLD = "cross-validation-fold-{}"
RUN_FINAL = "final-model"
RUN_FINAL_STEPS = ("data-preprocessing", "model-training", "model-saving")
RUN_SEARCH = "hyperparameter-tuning"
RUN_TRIAL = "trial-{}"

FOLD_METRICS = "fold bigint, metric string, value double"
TRIAL = (
    "trial bigint, learning_rate double, units bigint, dropout_rate double, batch_size bigint, epochs bigint"
)
RUNS = (
    "run_id string, parent_run_id string, run_name string, kind string, key string, step bigint, "
    "num double, str string, ts timestamp"
)
REGISTRY = (
    "name string, version bigint, path string, run_id string, feature_names array<string>, "
    "target_classes array<string>, trained_at timestamp"
)
