"""A left join of many rows with a table of unique keys, where one key may be held by a third of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of at most so many keys is broadcast whole.
MOST_BROADCAST = 100_000
#: A key held by more than one row in so many is heavy; there are at most so many of these.
HEAVY = 1_000
SPREAD = 1_024


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, most: int = MOST_BROADCAST) -> DataFrame:
    """``rows`` with the other columns of ``table``, null where it lacks the key. Null keys meet null keys.

    ``table`` should be stored, with one row a key; ``weight`` is its column of how many rows hold the key. A small table is
    broadcast, which its row count decides. Of a larger one the heavy keys are broadcast and their rows kept out of the shuffled join of the others, where
    they would fill one partition: they get spread numbers that match nothing.
    """
    known = [c for c in table.columns if c not in keys and c != weight]

    def met(left: DataFrame, right: DataFrame, extra=()):
        named = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + list(extra))
        return left.join(named, on, "left").drop(*[f"_k_{k}" for k in keys])

    size = table.agg(F.count("*").alias("n"), F.sum(weight).alias("rows")).first()
    if size["n"] <= most:
        return met(rows, F.broadcast(table.select(*keys, *known)))
    heavy = F.col(weight) * HEAVY > size["rows"]
    first = F.broadcast(table.where(heavy).select(*keys, F.struct(*known).alias("_first")))
    spread = F.when(F.col("_first").isNull(), 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)))
    marked = met(rows, first).withColumn("_spread", spread.cast("long"))
    # no literal and nothing that is simplified to one: the optimizer would take it out of the keys of the join
    zero = (F.col(weight) % 1).cast("long")
    rest = table.where(~heavy).select(*keys, F.struct(*known).alias("_rest"), zero.alias("_none"))
    both = met(marked, rest, [F.col("_spread") == F.col("_none")]).withColumn("_found", F.coalesce("_first", "_rest"))
    return both.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in known])
