"""Gradient-boosted trees: fitted by Spark ML, used as a SQL expression or on numpy rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Boosted:
    """Trees as (weight, nodes); a node is (feature, threshold, left, right, value), a leaf has feature -1. Empty: margin 0."""

    trees: tuple[tuple[float, tuple[tuple[int, float, int, int, float], ...]], ...] = ()

    def sql(self, names: list[str]) -> str:
        """The margin as a SQL expression over these feature expressions; the chance is ``1 / (1 + exp(-2 * margin))``."""

        def node(nodes, i: int) -> str:
            feature, threshold, left, right, value = nodes[i]
            return f"{value!r}D" if feature < 0 else f"CASE WHEN {names[feature]} <= {threshold!r}D THEN {node(nodes, left)} ELSE {node(nodes, right)} END"

        return " + ".join(f"{weight!r}D * ({node(nodes, 0)})" for weight, nodes in self.trees) or "0.0D"

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for weight, nodes in self.trees:
            feature, left, right = (np.array([n[i] for n in nodes]) for i in (0, 2, 3))
            threshold, value = (np.array([n[i] for n in nodes]) for i in (1, 4))
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                low = x[every, np.maximum(f, 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += weight * value[at]
        return total


def _nodes(tree) -> tuple:
    found: list = []

    def walk(node) -> int:
        i = len(found)
        found.append(None)
        if node.getClass().getSimpleName() == "LeafNode":
            found[i] = (-1, 0.0, 0, 0, float(node.prediction()))
        else:
            split = node.split()
            feature, threshold = int(split.featureIndex()), float(split.threshold())
            left = walk(node.leftChild())
            found[i] = (feature, threshold, left, walk(node.rightChild()), 0.0)
        return i

    walk(tree._call_java("rootNode"))
    return tuple(found)


def fit(rows: DataFrame, rounds: int = 15, depth: int = 4, step: float = 0.3, seed: int = 7) -> Boosted:
    """Boost on rows (features array<double>, label 0 or 1, and a weight if there is such a column); labels of one class only give no trees."""
    seen = rows.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return Boosted()
    weight = ["weight"] if "weight" in rows.columns else []
    ready = rows.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), *weight)
    boosted = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, minInstancesPerNode=5, cacheNodeIds=False)
    model = (boosted.setWeightCol("weight") if weight else boosted).fit(ready)
    return Boosted(tuple((float(w), _nodes(tree)) for w, tree in zip(model.treeWeights, model.trees)))
