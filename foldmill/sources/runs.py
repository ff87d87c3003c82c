"""Run records as one append-only table: parameters, metrics by step, and parent and child runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill.schemas import RUNS
from foldmill.session import checkpoint
from foldmill.sources.tables import append, read_merged


class Run:
    """Collects the records of one run (a handful of driver-side values) until they are appended."""

    def __init__(self, name: str, when: datetime, parent: "Run | None" = None, run_id: str | None = None):
        self.run_id = run_id or uuid.uuid4().hex
        self.name, self.when, self.parent = name, when, parent
        self.records: list[tuple] = []
        self._add("run", "started", None, None, None)

    def _add(self, kind, key, step, num, text):
        parent_id = self.parent.run_id if self.parent else None
        self.records.append((self.run_id, parent_id, self.name, kind, key, step, num, text, self.when))

    def child(self, name: str) -> "Run":
        return Run(name, self.when, self)

    def param(self, key: str, value) -> None:
        self._add("param", key, None, None, str(value))

    def metric(self, key: str, value: float, step: int | None = None) -> None:
        self._add("metric", key, step, float(value), None)

    def history(self, rows: list[dict]) -> None:
        names = {"loss": "train_loss", "accuracy": "train_accuracy"}
        for row in rows:
            for key, value in row.items():
                if key != "step":
                    self.metric(names.get(key, key), value, row["step"])


def run_rows(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """The records of some runs as rows of the run table."""
    return spark.createDataFrame([r for run in runs for r in run.records], RUNS)


def append_runs(spark: SparkSession, path: str, runs: list[Run]) -> None:
    append(run_rows(spark, runs).coalesce(1), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_merged(spark, path)


def rollup(runs: DataFrame) -> DataFrame:
    """Per parent run, the mean of each metric over its children's last steps."""
    last = (
        runs.filter(F.col("kind") == "metric")
        .groupBy("parent_run_id", "run_id", "key")
        .agg(F.max_by("num", F.coalesce("step", F.lit(-1))).alias("num"))
    )
    parents = runs.filter(F.col("kind") == "run").select(
        F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent_name")
    )
    return (
        last.join(parents.distinct(), "parent_run_id")
        .groupBy("parent_run_id", "parent_name", "key")
        .agg(F.avg("num").alias("avg_num"), F.count("*").alias("n_children"))
    )


#: Deepest tree that is followed.
LEVELS = 1_000


def run_tree(runs: DataFrame) -> DataFrame:
    """Every run below a root: run_id, root_id, depth, path (names from the root), and for each metric the mean of its last steps over the run and all below it, with their number.

    Runs without any metric in their subtree have one row with null. A recursive query follows children from the runs that have no known parent; a run that would meet itself again
    is not followed, and runs whose parents form a ring have no root and no rows.
    """
    spark, view = runs.sparkSession, f"runs_{uuid.uuid4().hex}"
    runs.filter("kind = 'run'").select("run_id", "parent_run_id", "run_name").distinct().createOrReplaceTempView(view)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit")}
    spark.conf.set("spark.sql.cteRecursionLevelLimit", LEVELS)
    spark.conf.set("spark.sql.cteRecursionRowLimit", -1)
    try:
        tree = spark.sql(f"""
            with recursive tree(run_id, root_id, depth, path, above) as (
                select run_id, run_id, 0, run_name, array(run_id) from {view} r
                where not exists (select 1 from {view} p where p.run_id = r.parent_run_id)
                union all
                select c.run_id, t.root_id, t.depth + 1, concat(t.path, '/', c.run_name), concat(t.above, array(c.run_id))
                from tree t join {view} c on c.parent_run_id = t.run_id where not array_contains(t.above, c.run_id))
            select * from tree""")
        tree = checkpoint(tree)  # run once, while the limits hold
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        spark.catalog.dropTempView(view)
    last = runs.filter("kind = 'metric'").groupBy("run_id", "key").agg(F.max_by("num", F.coalesce("step", F.lit(-1))).alias("num"))
    below = tree.select("run_id", F.explode("above").alias("over")).join(last, "run_id").groupBy("over", "key").agg(F.avg("num").alias("avg_num"), F.count("*").alias("n_runs"))
    return tree.join(below, tree["run_id"] == below["over"], "left").select(tree["run_id"], "root_id", "depth", "path", "key", "avg_num", "n_runs")
