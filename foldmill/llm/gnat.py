"""Vector codes: each sixteenth of a vector is replaced by the number of its nearest codebook entry, found in a GNAT.

A GNAT (geometric near-neighbour access tree) holds the entries of one part position. A node has a few split points, far from each other; every other
entry belongs to its nearest split point, and the node keeps, for each split point and each child, the least and greatest distance
between the point and the child's entries. A search measures its distance to the split points. A child cannot hold an entry as near as the best
one if, seen from any split point, the ball around the query and the child's range of distances do not meet; then its whole subtree is skipped.

Squared distances are whole numbers. Their roots are rounded outwards on both sides of each comparison, and a subtree
is skipped only if it lies strictly outside, so entries at the best distance are always reached and compared as whole numbers, ties going to
the lower entry. Codes therefore equal those of a search through all entries.

Codebooks begin with the vectors of the smallest vec_ids and are moved by rounds of assignment and means (rounded down). A
round is one pass: tasks add up whole numbers for each entry, at most ``PARTS * ENTRIES`` rows each, and Spark adds those up, so the result does not depend on how
the table is cut. The driver holds the codebooks only: ``ENTRIES`` vectors.

Rows whose vector is null or holds null or non-finite components are dropped. Repeated rows and vec_ids are coded one by one (ties among the first
ones by content); a null vec_id comes after all others. With fewer than ``ENTRIES`` rows the codebooks are shorter. Lengths that are no multiple of sixteen are cut as evenly as
whole numbers allow, shorter vectors are filled up with zeros. An empty table gives no rows. Columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import ready, stored
from foldmill.llm.integer_vectors import integer_vectors, matrix_of
from foldmill.operators.lookup import lookup

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Split points of a node, and the most entries of a leaf.
SPLITS, LEAF = 8, 8
#: Relative slack that covers every rounding of roots and their sums.
SLACK = 1e-12
ROWS_AT_ONCE = 16_384


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of ``a`` and of ``b``, as whole numbers."""
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        out += (a[:, k, None] - b[None, :, k]) ** 2
    return out


@dataclass
class _Node:
    places: np.ndarray
    points: np.ndarray
    children: list
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    """Nearest entries of a codebook (whole numbers, a row an entry)."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.entries, self.splits, self.leaf = np.asarray(entries, np.int64), splits, leaf
        self.root = self._node(np.arange(len(self.entries)))

    def _node(self, places: np.ndarray) -> _Node:
        entries = self.entries[places]
        if len(places) <= max(self.leaf, 1):
            return _Node(places, entries, [])
        chosen = [0]
        nearest = squared(entries, entries[:1])[:, 0]
        while len(chosen) < self.splits and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(entries, entries[chosen[-1:]])[:, 0])
        if len(chosen) == 1:  # equal entries
            return _Node(places, entries, [])
        from_splits = squared(entries[chosen], entries)
        owner = from_splits.argmin(axis=0)
        owner[chosen] = -1
        low, high, children = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(chosen))), []
        for j in range(len(chosen)):
            held = np.flatnonzero(owner == j)
            children.append(self._node(places[held]) if len(held) else None)
            if len(held):
                low[:, j] = np.sqrt(from_splits[:, held].min(axis=1)) * (1 - SLACK)
                high[:, j] = np.sqrt(from_splits[:, held].max(axis=1)) * (1 + SLACK)
        return _Node(places[chosen], entries[chosen], children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry's place and squared distance for each query, and how many distances were measured."""
        distance, place = np.full(len(queries), np.iinfo(np.int64).max), np.full(len(queries), len(self.entries))
        self.measured = 0
        for at in range(0, len(queries), ROWS_AT_ONCE):
            part = slice(at, at + ROWS_AT_ONCE)
            self._visit(self.root, queries[part], np.arange(len(queries[part])), distance[part], place[part])
        return place, distance, self.measured

    def _visit(self, node: _Node, queries, rows, distance, place) -> None:
        found = squared(queries[rows], node.points)
        self.measured += found.size
        least = found.min(axis=1)
        first = np.where(found == least[:, None], node.places[None, :], len(self.entries)).min(axis=1)
        better = (least < distance[rows]) | ((least == distance[rows]) & (first < place[rows]))
        distance[rows[better]], place[rows[better]] = least[better], first[better]
        if not node.children:
            return
        away, own = np.sqrt(found), found.argmin(axis=1)
        near, far = away * (1 - SLACK), away * (1 + SLACK)
        for home in (True, False):  # the child of the nearest split point first: it shrinks the ball
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                at = np.flatnonzero((own == j) == home)
                ball = (np.sqrt(distance[rows[at]]) * (1 + SLACK))[:, None]
                met = ((near[at] - ball <= node.high[:, j]) & (far[at] + ball >= node.low[:, j])).all(axis=1)
                if met.any():
                    self._visit(child, queries, rows[at[met]], distance, place)


def edges_of(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def codes_of(x: np.ndarray, trees: list[Gnat], edges) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers (a column a part) and the summed squared distances of some vectors."""
    codes, error = np.zeros((len(x), len(trees)), np.int64), np.zeros(len(x), np.int64)
    for p, (tree, (a, b)) in enumerate(zip(trees, edges)):
        codes[:, p], distance, _ = tree.nearest(np.ascontiguousarray(x[:, a:b]))
        error += distance
    return codes, error


def moved(rows: DataFrame, books: list[np.ndarray], edges) -> list[np.ndarray]:
    """The codebooks after one round: each entry becomes the mean, rounded down, of the parts it is nearest to."""
    length, entries, width = edges[-1][1], len(books[0]), max(b - a for a, b in edges)

    def run(batches):
        trees = [Gnat(book) for book in books]
        count, total = np.zeros((len(books), entries), np.int64), np.zeros((len(books), entries, width), np.int64)
        for batch in batches:
            x = matrix_of(batch.column(0), length)
            codes, _ = codes_of(x, trees, edges)
            for p, (a, b) in enumerate(edges):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], (codes[:, p], slice(0, b - a)), x[:, a:b])
        part, entry = np.nonzero(count)
        columns = [part, entry, count[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["part", "entry", "n", *[f"s{k}" for k in range(width)]]
    sums = rows.select("x").mapInArrow(run, ", ".join(f"{n} long" for n in names)).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]])
    out = [book.copy() for book in books]
    for row in sums.collect():  # PARTS * ENTRIES rows at most
        width_here = out[row["part"]].shape[1]
        out[row["part"]][row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width_here)]
    return out


def first_books(rows: DataFrame, edges, entries: int = ENTRIES) -> list[np.ndarray]:
    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r["x"] for r in first], np.int64).reshape(len(first), edges[-1][1])
    return [x[:, a:b] for a, b in edges]


def coded(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (two hex digits a part) and error of every row that takes part, stored, and the codebooks."""
    spark = ready(vectors.sparkSession)
    rows, length = integer_vectors(vectors, "label")
    edges = edges_of(length)
    books = first_books(rows, edges)
    if len(books[0]):
        for _ in range(rounds):
            books = moved(rows, books, edges)

    def run(batches):
        trees = [Gnat(book) for book in books]
        for batch in batches:
            codes, error = codes_of(matrix_of(batch.column(2), length), trees, edges)
            digits = codes.astype(np.uint8).tobytes().hex()
            step = 2 * len(trees)
            code = [digits[i : i + step] for i in range(0, len(digits), step)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, code string, error long"
    if not len(books[0]):
        return spark.createDataFrame([], schema), books
    return stored(rows.select("vec_id", "label", "x").mapInArrow(run, schema), "codes"), books


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part."""
    rows, books = coded(vectors)
    listed = ",".join(str(c) for book in books for c in book.ravel().tolist())
    sums = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label_errors")
    named = lookup(rows, sums, ["label"], "n").withColumn("codebooks_sha256", F.lit(hashlib.sha256(listed.encode()).hexdigest()))
    return named.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
