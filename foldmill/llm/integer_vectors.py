"""Embeddings as vectors of whole numbers, as the code and whitening operators take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 256
#: Whole numbers stay within this; only components beyond 262,144 reach it. Squared distances then fit 64 bits.
LIMIT = 2**26


def integer_vectors(vectors: DataFrame, *more: Column | str) -> tuple[DataFrame, int]:
    """vec_id, the columns ``more`` and x (array of floor(256 * component)) of the rows that take part, and the length of x.

    Rows take no part if the vector is null or holds null or non-finite components. Shorter vectors are filled up with zeros; a table
    without vectors has length 0.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *more, v.alias("v")).where(F.col("v").isNotNull() & finite)
    sizes = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    length = sizes["most"] or 0
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * STEPS, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))))
    if sizes["least"] != sizes["most"]:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), length - F.size("v")))
    return rows.withColumn("x", x).drop("v"), length


def matrix_of(column: pa.Array, length: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)
