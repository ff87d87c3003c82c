"""Nearest neighbours by largest inner product: a block matrix join over int8 tiles with error bounds.

Vectors are packed in blocks, in the table's own type (float stays float), and the blocks dealt over a grid of tasks: a cell holds up to ``HELD`` query blocks, and a share of
the candidate blocks goes past them. A query block is sent along its row of cells, a candidate block along its column, so the shuffle carries each
candidate once for every ``HELD`` query blocks, not a pair of blocks for every tile, and a task's memory does not grow with the table. Every query block meets every candidate block once. A tile
whose largest product of norms is below what all its queries already have is passed over. In
a tile the vectors' int8 forms are multiplied (as whole numbers in float32, which is exact up to 1,040 dimensions; float64 beyond); with
the norms of the rounding errors this bounds each product from both sides. A pair survives unless its upper bound is below the
``k``-th largest lower bound, or below the ``k``-th best score that the query already has. Survivors are computed in double precision, and
each query's best are kept in a heap while its block stays in the cell; the tasks' heaps are merged by a grouped top-k.

The result is exact: recall is 1. Vectors that are null, zero, or hold null or non-finite components take no part, neither as
query nor as candidate. Vectors of another length are compared among themselves only. Ties go to the smaller vec_id; a
row whose vec_id repeats stays a candidate of its twin, a null vec_id is not a query and loses ties. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.llm.common import partitions, ready, stored

#: Vectors of a candidate block and of a query block.
BLOCK, ASKED = 2048, 256
#: Query blocks that a cell holds at once, and the bytes of doubles they may take.
HELD, HELD_BYTES = 64, 64 << 20
#: About the bytes of one found pair in the shuffle.
PAIR = 40
PAYLOAD = ("rids", "ids", "named", "vectors")
FOUND_SCHEMA = "query long, query_id long, rid long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """rid, vec_id, v (array of float if the table has floats, else of double), dim of the vectors that take part, written once."""
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    v = F.col("embedding") if floats else F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & fine)
    return stored(rows.withColumn("dim", F.size("v")), "vectors")


def packed(rows: DataFrame, count: int, block: int = BLOCK) -> DataFrame:
    """Blocks of about ``block`` vectors of one length; a block's number is dense from 0."""
    n = max(1, -(-count // block))
    kind = np.float32 if rows.schema["v"].dataType.simpleString() == "array<float>" else np.float64

    def pack(key, pdf):
        rid, ids = pdf["rid"].to_numpy(np.int64), pdf["vec_id"]
        named = ids.notna().to_numpy()
        matrix = np.array(pdf["v"].tolist(), kind)
        import pandas as pd

        return pd.DataFrame([[key[0], key[1], rid.tobytes(), ids.fillna(0).to_numpy(np.int64).tobytes(), named.tobytes(), matrix.tobytes()]], columns=["part", "dim", "rids", "ids", "named", "vectors"])

    ready(rows.sparkSession)
    parts = rows.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(n))).groupBy("part", "dim").applyInPandas(pack, "part long, dim int, rids binary, ids binary, named binary, vectors binary")
    return stored(parts, "parts")


def numbered(parts: DataFrame) -> DataFrame:
    """Blocks with numbers dense within their length, one row a block."""
    keys = parts.select("part", "dim").withColumn("block", F.row_number().over(Window.partitionBy("dim").orderBy("part")).cast("long") - 1)
    return parts.join(keys, ["part", "dim"]).select("block", "dim", *PAYLOAD)


def dealt(queries: DataFrame, candidates: DataFrame, tasks: int, k: int = 20, held: int = HELD, block: int = ASKED) -> DataFrame:
    """All blocks of a cell (dim, row, column) in one task: its query blocks first, then its candidate blocks.

    More rows send candidates more often, more columns send queries more often and return more pairs; the grid has about as many cells as there are tasks, in the shape
    that moves the fewest bytes, and more rows where a cell could not hold its queries.
    """
    asked = queries.groupBy("dim").agg(F.count("*").alias("asked"), F.sum(F.length("rids")).alias("asked_bytes"))
    there = candidates.groupBy("dim").agg(F.count("*").alias("there"), F.sum(F.length("rids")).alias("there_bytes"))
    share = F.col("asked_bytes") / F.greatest("there_bytes", F.lit(1))  # of vectors, since all have one rid
    best = F.ceil(F.sqrt(tasks * share * (1 + k * PAIR / (4 * F.col("dim")))))
    fit = F.greatest(F.lit(1), F.least(F.lit(held), F.floor(F.lit(HELD_BYTES) / (F.col("dim") * 8 * block))))
    grid = asked.join(there, "dim").withColumn("held", F.least(fit, F.ceil(F.col("asked") / F.greatest(best, F.lit(1)))).cast("long"))
    grid = grid.withColumn("rows", F.ceil(F.col("asked") / F.col("held")))
    grid = grid.select("dim", "held", "rows", F.least("there", F.greatest(F.lit(1), F.ceil(F.lit(tasks) / F.col("rows")))).cast("long").alias("columns"))
    zero = F.lit(0).cast("long")
    along_row = queries.join(grid, "dim").select("dim", "columns", F.floor(F.col("block") / F.col("held")).alias("row"), F.explode(F.sequence(zero, F.col("columns") - 1)).alias("column"), F.lit(0).alias("side"), "block", *PAYLOAD)
    along_column = candidates.join(grid, "dim").select("dim", "columns", F.explode(F.sequence(zero, F.col("rows") - 1)).alias("row"), F.pmod("block", "columns").alias("column"), F.lit(1).alias("side"), "block", *PAYLOAD)
    both = along_row.unionByName(along_column).withColumn("task", F.pmod(F.col("row") * F.col("columns") + F.col("column") + F.xxhash64("dim"), F.lit(tasks)).cast("int"))
    return both.repartitionById(tasks, "task").drop("task", "columns").sortWithinPartitions("dim", "row", "column", "side", "block")


class _Block:
    def __init__(self, dim, rids, ids, named, vectors):
        self.rids, self.ids, self.named = np.frombuffer(rids, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(named, bool)
        kind = np.float32 if len(vectors) == 4 * dim * len(self.rids) else np.float64
        self.v = np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)
        top = np.abs(self.v).max(axis=1, keepdims=True)
        unit = self.v / top  # so that tiny and huge vectors have int8 forms too
        q = np.rint(unit * 127)
        self.scale = (top / 127).ravel()
        self.q = q.astype(np.float32 if dim <= 1040 else np.float64)
        self.norm = np.sqrt((unit**2).sum(axis=1)) * top.ravel()
        self.q_norm = np.sqrt((q**2).sum(axis=1)) * self.scale
        self.error = np.sqrt(((unit - q / 127) ** 2).sum(axis=1)) * top.ravel() * (1 + 1e-9)


def _tile(a: _Block, b: _Block, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surviving pairs (row of a, row of b) and their scores."""
    with np.errstate(over="ignore", invalid="ignore"):
        near = (a.q @ b.q.T).astype(np.float64) * a.scale[:, None] * b.scale[None, :]
        slack = a.q_norm[:, None] * b.error[None, :] + a.error[:, None] * b.norm[None, :]
        slack += 1e-12 * a.norm[:, None] * b.norm[None, :]
        lower, upper = near - slack, near + slack
    own = a.rids[:, None] == b.rids[None, :]
    lower[own] = -np.inf
    least = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(lower), -np.inf)
    i, j = np.nonzero(~(upper < np.maximum(least, floor)[:, None]) & ~own)
    scores = np.empty(len(i))
    step = max(1, 2_000_000 // a.v.shape[1])
    for s in range(0, len(i), step):
        scores[s : s + step] = (a.v[i[s : s + step]] * b.v[j[s : s + step]]).sum(axis=1)
    # a row of a has at most k of them in the result, so copies of one vector do not reach its heap by the thousand
    order = np.lexsort((b.rids[j], b.ids[j], ~b.named[j], -scores, i))
    first = np.searchsorted(i[order], np.arange(len(a.rids)))
    kept = order[np.arange(len(order)) - first[i[order]] < k]
    return i[kept], j[kept], scores[kept]


def _meet(mine: _Block, heaps: list[list], other: _Block, k: int) -> None:
    """Put the best of one tile into the heaps of its queries."""
    floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    with np.errstate(over="ignore", invalid="ignore"):
        if (mine.norm * other.norm.max() * (1 + 1e-9) < floor).all():
            return
    for i, j, score in zip(*(x.tolist() for x in _tile(mine, other, k, floor))):
        entry = (score, bool(other.named[j]), -int(other.ids[j]), -int(other.rids[j]))
        if len(heaps[i]) < k:
            heapq.heappush(heaps[i], entry)
        elif entry > heaps[i][0]:
            heapq.heapreplace(heaps[i], entry)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, block: int = BLOCK) -> DataFrame:
    """For each vector whose vec_id is divisible by ``every`` its ``k`` nearest others: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    candidates = stored(numbered(packed(rows, rows.count(), block)), "blocks")
    queries = stored(numbered(packed(asked, asked.count(), min(block, ASKED))), "queries")
    cells = dealt(queries, candidates, partitions(spark), k)
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        cell, held = None, []

        def found():
            for mine, heaps in held:
                entries = [(int(mine.rids[n]), int(mine.ids[n]), -rid, -i if named else None, score) for n, heap in enumerate(heaps) for score, named, i, rid in heap]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in entries], schema=schema)

        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                at = (row["dim"], row["row"], row["column"])
                if at != cell:
                    yield from found()
                    cell, held = at, []
                this = _Block(row["dim"], *(row[c] for c in PAYLOAD))
                if row["side"] == 0:
                    held.append((this, [[] for _ in this.rids]))
                    continue
                for mine, heaps in held:
                    _meet(mine, heaps, this, k)
        yield from found()

    found = cells.mapInArrow(run, FOUND_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
