"""Exact ranks in a seeded order, without sorting everything in one task.

Two forms:

* :func:`rank_cuts` finds the few rows at which the seeded order has to be cut (fold borders, split
  borders). Two narrow scans of the key column are enough, and every row is then placed by comparing
  it with those borders: the wide rows are never shuffled.
* :func:`global_rank` numbers every row, for the outputs that show the position itself. It shuffles
  once, on a hash prefix, which is uniform because keys are unique.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmill.functions.hashing import key_hash

# 16**4 prefixes: the table of prefix counts has at most 65,536 rows whatever the input size.
PREFIX_DIGITS = 4


@dataclass(frozen=True)
class RankCut:
    """The row with the given rank: rows from it onwards lie behind the cut."""

    hash: str
    key: Any

    def reached_by(self, key: str, seed: int | str) -> Column:
        h = key_hash(key, seed)
        behind = (h > F.lit(self.hash)) | ((h == F.lit(self.hash)) & (F.col(key) >= F.lit(self.key)))
        return F.coalesce(behind, F.lit(False))


def _prefix_counts(hashed: DataFrame, prefix: str) -> list[tuple[str, int]]:
    """Rows per hash prefix in order: at most 16**digits of them."""
    counted = hashed.groupBy(prefix).agg(F.count("*").alias("n")).toArrow()
    return sorted(zip(counted[prefix].to_pylist(), counted["n"].to_pylist()))


def rank_cuts(
    df: DataFrame, key: str, seed: int | str, ranks: Callable[[int], list[int]], digits: int = PREFIX_DIGITS
) -> tuple[int, list[RankCut | None]]:
    """Row count, and the cut at each rank of ``ranks(row_count)``; ``None`` past the last row.

    Rows that share a key lie on one side of every cut, behind it if the rank falls among them. They are counted before
    they are ranked, so a key that holds a third of the table is one row here.
    """
    hashed = df.select(F.col(key).alias("k"), key_hash(key, seed).alias("h"))
    hashed = hashed.withColumn("p", F.substring("h", 1, digits))
    counts = _prefix_counts(hashed, "p")
    total = sum(c for _, c in counts)

    places: dict[int, tuple[str, int]] = {}
    asked = ranks(total)
    for rank in sorted({r for r in asked if r < total}):
        before = 0
        for prefix, count in counts:
            if rank < before + count:
                places[rank] = (prefix, rank - before)
                break
            before += count
    if not places:
        return total, [None for _ in asked]

    before = Window.partitionBy("p").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    keys = hashed.filter(F.col("p").isin(sorted({p for p, _ in places.values()}))).groupBy("p", "h", "k").agg(F.count("*").alias("c"))
    keys = keys.withColumn("n", F.coalesce(F.sum("c").over(before), F.lit(0)))
    at_border = F.lit(False)
    for prefix, offset in places.values():
        at_border = at_border | ((F.col("p") == prefix) & (F.col("n") <= offset) & (F.col("n") + F.col("c") > offset))
    found = keys.filter(at_border).collect()  # a row for each cut at most

    cuts: dict[int, RankCut] = {}
    for rank, (prefix, offset) in places.items():
        row = next(r for r in found if r["p"] == prefix and r["n"] <= offset < r["n"] + r["c"])
        cuts[rank] = RankCut(row["h"], row["k"])
    return total, [cuts.get(r) for r in asked]


def cuts_passed(cuts: list[RankCut | None], key: str, seed: int | str) -> Column:
    """How many of the cuts a row lies behind, as bigint: a plain projection."""
    passed = F.lit(0).cast("bigint")
    for cut in cuts:
        if cut is not None:
            passed = passed + cut.reached_by(key, seed).cast("bigint")
    return passed


def global_rank(
    df: DataFrame, key: str, seed: int | str, name: str = "position", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Add the exact zero-based position of every row in the seeded order.

    A key that repeats has no defined positions: the job fails with its name, however often it repeats.
    """
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn("_p", F.substring("_h", 1, digits))
    counts = _prefix_counts(hashed, "_p")
    starts = list(accumulate((c for _, c in counts), initial=0))[:-1]
    # At most 16**digits rows, so the broadcast is safe.
    offsets = pa.table({"_p": pa.array([p for p, _ in counts], pa.string()), "_before": pa.array(starts, pa.int64())})
    table = df.sparkSession.createDataFrame(offsets)
    within = Window.partitionBy("_p").orderBy("_h", key)
    again = F.col("_h").eqNullSafe(F.lag("_h").over(within)) & F.col(key).eqNullSafe(F.lag(key).over(within)) & (F.row_number().over(within) > 1)
    refused = F.raise_error(F.concat(F.lit(f"RepeatedKey: {key} does not identify rows: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return (
        hashed.withColumn("_n", F.when(again, refused.cast("int")).otherwise(F.row_number().over(within) - 1))
        .join(F.broadcast(table), "_p")
        .withColumn(name, (F.col("_before") + F.col("_n")).cast("bigint"))
        .drop("_h", "_p", "_n", "_before")
    )
