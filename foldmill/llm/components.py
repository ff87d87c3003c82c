"""Connected components of a table of links, on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """Columns node, root (the smallest node reachable) for every node of ``links`` (columns a, b: longs, a != b).

    Alternates large-star and small-star steps: every node is linked to the smallest node it sees, until the links are
    stars. Each step is a grouped minimum, combined before the shuffle, and an equi-join that adaptive execution can split; each
    round is written to the shared folder. The number of rounds grows with the logarithm of the longest chain.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
        before = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        done, links = links, stored(small, "links")
        discard(done)
