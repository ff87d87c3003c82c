"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies. Among all rates that meet the sources' token targets
the ones closest to 1 in relative entropy (weighed by tokens) are exponentially tilted: ``rate = exp(dual of its source)``. The convex dual,
``sum of tokens * exp(dual) - target * dual``, is solved by Newton's method on the executors: one pass over the documents gives every source's
tokens, and each iteration takes a Newton step of all sources' duals at once (a document belongs to one source, so the Hessian is diagonal).

Rates become whole copies so that totals come out: per source, the documents are grouped by size, sizes are walked from the largest to the
smallest, and each group gets the number of copies that brings the running total closest to its expectation, so an error is
passed on to smaller documents and ends below the smallest. Within a group all documents get the same
number, but for a remainder that goes to the documents of the lowest rank by a hash of doc_id, so it does not depend on how the table is cut; ranks are
counted in ``SHARES`` shares, so a group that holds a third of all rows is still ranked by many tasks. Rows of one doc_id (and size and source) are counted
before they are ranked; only where the remainder ends among them are they told apart, by their place in the table.

Null text has size 0; documents of size 0 take no words and get their rounded rate of copies. A null source is a source of its own, last in
order. Sources without words have target 0. Repeated rows count as often as they occur. Extra columns are kept apart. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.llm.common import partitions, stored

WEIGHTS = (1, 2, 3)
MOST = 3.0
SHARES = 256
#: Newton starts at rate 1 and falls by at most 1 a step in the dual, then converges quadratically.
STEPS = 60
TOLERANCE = 1e-12


def sized(docs: DataFrame) -> DataFrame:
    """rid, doc_id, source, size (words) of each document, written once: ``rid`` tells repeated rows apart from here on."""
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("source").cast("string").alias("source"), size.alias("size")), "sizes")


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources (source, tokens) with the weight of their place in code point order, null last; written once.

    Places are counted within the tasks of a range shuffle, which are as many as the session has, and offset by the counts of the tasks before.
    """
    order = [F.col("source").isNull(), F.col("source")]
    tasks = partitions(sources.sparkSession)
    rows = stored(sources.repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()), "sources")
    offsets = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = rows.withColumn("inner", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1).join(F.broadcast(offsets), "part")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("before") + F.col("inner"), F.lit(len(weights))) + 1).cast("int"))
    return stored(rows.select("source", "tokens", weight.cast("double").alias("weight")), "weights")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Sources (source, tokens) with their target: all tokens shared by weight, at most ``most`` times a source's own, the excess
    shared again among the others until none is above. A round is one sum over the sources; the level only rises, so the driver holds nothing but the last one."""
    rows = weighted(sources, weights)
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    left, share, closed = float(total), 0.0, -1
    above = F.lit(False)
    while True:
        open_ = (F.col("tokens") > 0) & ~above
        found = rows.agg(F.sum(above.cast("long")), F.sum(F.when(above, F.col("tokens"))), F.sum(F.when(open_, F.col("weight")))).first()
        if (found[0] or 0) == closed:
            break
        closed, left, share = found[0] or 0, total - most * (found[1] or 0), found[2] or 0.0
        if not share:
            break
        above = (F.col("tokens") > 0) & (F.col("weight") * F.lit(left) / F.lit(share) > most * F.col("tokens"))
    part = F.col("weight") * F.lit(left) / F.lit(share) if share else F.lit(0.0)
    target = F.when(F.col("tokens") <= 0, 0.0).when(above, most * F.col("tokens")).otherwise(part)
    return rows.select("source", "tokens", target.alias("target"))


def rates(sized_docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, tokens, target, rate for every source."""
    sums = sized_docs.groupBy("source").agg(F.sum("size").alias("tokens"))
    found = stored(targets(sums, weights, most).withColumn("dual", F.lit(0.0)), "targets")
    moving = (F.col("tokens") > 0) & (F.col("target") > 0)
    expected = F.col("tokens") * F.exp("dual")
    gap = F.abs(expected - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
    for _ in range(STEPS):
        if (found.where(moving).agg(F.max(gap)).first()[0] or 0.0) <= TOLERANCE:
            break
        for _ in range(6):  # Newton steps between two looks at the gap
            found = found.withColumn("dual", F.when(moving, F.col("dual") - (expected - F.col("target")) / expected).otherwise(F.col("dual")))
        found = stored(found, "duals")
    rate = F.when(moving, F.least(F.exp("dual"), F.lit(most))).otherwise(0.0)
    return found.select("source", "tokens", "target", rate.alias("rate"))


def copies(sized_docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``sized`` with source_size, target and copies."""
    found = stored(rates(sized_docs, weights, most), "rates")
    groups = sized_docs.groupBy("source", "size").agg(F.count("*").alias("n"))
    groups = groups.join(F.broadcast(found) if found.count() <= 10_000 else found, groups["source"].eqNullSafe(found["source"])).select(groups["source"], "size", "n", "rate")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        """Copies of each group of equal size; a source has as many rows here as it has distinct sizes."""
        rows = rows.sort_values("size", ascending=False, ignore_index=True)
        wanted = taken = 0.0
        out = []
        for size, n, rate in zip(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist()):
            wanted += rate * n * size
            whole = round((wanted - taken) / size) if size else round(rate * n)
            whole = min(max(whole, int(np.floor(rate)) * n), int(np.ceil(rate)) * n)
            taken += whole * size
            out.append(whole)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "n": rows["n"], "whole": out})

    groups = stored(groups.groupBy("source").applyInPandas(walk, "source string, size long, n long, whole long"), "groups")
    cell = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))
    hashed = F.xxhash64(F.lit("mix"), "doc_id")
    docs = sized_docs.groupBy("source", "size", "doc_id").agg(F.count("*").alias("m")).withColumn("hashed", hashed).withColumn("share", F.pmod("hashed", F.lit(SHARES)))
    counts = docs.groupBy("source", "size", "share").agg(F.sum("m").alias("k"))
    counts = counts.withColumn("before", F.coalesce(F.sum("k").over(_before(["source", "size"], ["share"])), F.lit(0)))
    counts = counts.alias("c").join(groups.alias("g"), cell("c", "g")).select("c.source", "c.size", "c.share", "c.before", "g.n", "g.whole")
    inner = F.coalesce(F.sum("m").over(_before(["source", "size", "share"], ["hashed", "doc_id"])), F.lit(0))
    docs = docs.withColumn("inner", inner).alias("d").join(counts.alias("c"), cell("d", "c") & (F.col("d.share") == F.col("c.share")))
    base = F.floor(F.col("whole") / F.col("n"))
    extra = F.least(F.greatest(F.col("whole") - base * F.col("n") - F.col("before") - F.col("inner"), F.lit(0)), F.col("m"))
    docs = docs.select("d.source", "d.size", "d.doc_id", "m", base.alias("base"), extra.alias("extra"))
    found_docs = stored(sized_docs.alias("r").join(docs.alias("d"), cell("r", "d") & F.col("r.doc_id").eqNullSafe(F.col("d.doc_id"))).select("r.rid", "r.doc_id", "r.source", "r.size", "m", "base", "extra"), "copies")
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("m"))
    kept = ["rid", "doc_id", "source", "size"]
    alike = found_docs.where(~partly).select(*kept, (F.col("base") + (F.col("extra") > 0).cast("long")).alias("copies"))
    ranked = alike.unionByName(_ranked(found_docs.where(partly)).select(*kept, (F.col("base") + (F.col("rank") <= F.col("extra")).cast("long")).alias("copies")))
    small = found.select(F.col("source").alias("s"), F.col("tokens").alias("source_size"), "target")
    return ranked.join(small, ranked["source"].eqNullSafe(small["s"])).drop("s")


def _before(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their rank among the rows of one source, size and doc_id, counted in shares of rid."""
    one = ["source", "size", "doc_id"]
    rows = rows.withColumn("share", F.pmod(F.xxhash64("rid"), F.lit(SHARES)))
    counts = rows.groupBy(*one, "share").agg(F.count("*").alias("k"))
    counts = counts.withColumn("before", F.coalesce(F.sum("k").over(_before(one, ["share"])), F.lit(0)))
    rows = rows.withColumn("inner", F.row_number().over(Window.partitionBy(*one, "share").orderBy("rid")))
    same = F.col("share") == F.col("c_share")
    for name in one:
        same = same & F.col(name).eqNullSafe(F.col(f"c_{name}"))
    counts = counts.select(*(F.col(x).alias(f"c_{x}") for x in [*one, "share"]), "before")
    return rows.join(counts, same).withColumn("rank", F.col("before") + F.col("inner"))


def mixture(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies."""
    return copies(sized(docs)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row repeated by its copies; columns as they were."""
    held = stored(docs.withColumn("__rid", F.monotonically_increasing_id()), "numbered")
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    thin = stored(held.select(F.col("__rid").alias("rid"), "doc_id", F.col("source").cast("string").alias("source"), size.alias("size")), "sizes")
    wanted = copies(thin).where("copies > 0").select(F.col("rid").alias("__rid"), F.col("copies").alias("__copies"))
    # the thin side is hashed, so that the texts are streamed through the join and never sorted
    rows = held.join(wanted.hint("shuffle_hash"), "__rid").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    return rows.select(*docs.columns)
