"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is linear in its features; the chance that one document is preferred to another is the logistic function of the
difference of their strengths. Preference pairs are a document labelled 1 before one labelled 0. The weights minimise the logistic loss
over the feature differences (with a small ridge), by Newton's method. The threshold is the quantile of the labelled documents' strengths at the
share of label 0; strengths become scores by a logistic curve that passes through ``KEEP`` at that threshold.

Labels are learned from a sample of at most ``SAMPLE`` labelled rows of each class, the first in the order of a hash of doc_id, from rows that
are not held out. Doc_ids with several labels count by their mean. Features come from the text alone.

Null and empty texts are scored like any other. With labels of one class only every score is that class (1 or 0), without labels
``KEEP``: all documents are kept. A null doc_id is not held out and has no label. Ties and repeated rows get equal scores. An empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import ready

SAMPLE = 6_000
PAIRS_EACH = 6
RIDGE = 1e-3
KEEP = 0.7
NAMES = (
    "words", "word_length", "repeated_word", "distinct_words", "distinct_pairs", "repeated_line", "line_length", "capitals", "digits", "stops", "commas", "bars",
    "exclaims", "symbols", "other_marks", "wordless", "top_byte", "one_byte_words",
)

_SETS = {
    "capitals": range(65, 91), "digits": range(48, 58), "stops": b".", "commas": b",", "bars": b"|", "exclaims": b"!", "symbols": b"*#%&$@^~_=+<>{}[]\\/",
    "other_marks": b"\"'()-:;?`", "blanks": b" \n\t\r\x0b\x0c",
}


def features(text: bytes) -> np.ndarray:
    """The features of one text, shares as square roots so that small ones show."""
    x = np.zeros(len(NAMES))
    words = text.split()
    n = len(words)
    if not n:
        x[15] = 1.0
        return x
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    count = {name: int(seen[list(of)].sum()) for name, of in _SETS.items()}
    shown = len(text) - count["blanks"]
    lines = [line for line in text.split(b"\n") if line]
    x[0] = np.log1p(n) / 5
    x[1] = min(shown / n, 40) / 10
    pairs = max(n - 1, 1)
    x[2] = np.sqrt(sum(map(eq, words[1:], words)) / pairs)
    x[3] = np.log1p(len(set(words))) / np.log1p(n)
    x[4] = np.sqrt(1 - len(set(zip(words, words[1:]))) / pairs) if n > 1 else 0.0
    x[5] = np.sqrt(1 - len(set(lines)) / max(len(lines), 1))
    x[6] = np.log1p(len(text) / max(len(lines), 1)) / 5
    for i, name in enumerate(("capitals", "digits", "stops", "commas", "bars", "exclaims", "symbols", "other_marks")):
        x[7 + i] = np.sqrt(count[name] / shown)
    x[16] = seen[33:].max() / shown
    x[17] = np.sqrt(sum(len(w) == 1 for w in words[:]) / n)
    return x


def _featured(batches, lead: int):
    """(batch, feature matrix) for batches whose column ``lead`` is the text."""
    for batch in batches:
        yield batch, np.array([features(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(lead)]).reshape(-1, len(NAMES))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Features and labels of the bounded sample, and the share of label 0 among all rows it is drawn from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("label"))
    share = usable.agg(F.avg(1.0 - F.col("label"))).first()[0]
    if share is None:
        return np.zeros((0, len(NAMES))), np.zeros(0), 0.0
    picked = [usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    picked = picked[0].unionByName(picked[1])
    ids = docs.sparkSession.createDataFrame(picked.toArrow())  # 2 * most rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")

    def run(batches):
        for batch, x in _featured(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    ready(docs.sparkSession)
    rows = texts.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, x array<double>")
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")).orderBy("doc_id").collect()  # one row a sampled doc_id
    return np.array([r["x"] for r in rows]).reshape(-1, len(NAMES)), np.array([r["label"] for r in rows]), float(share)


class BradleyTerry:
    """Strengths and scores of feature rows."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def fit(self, x: np.ndarray, y: np.ndarray, share: float, each: int = PAIRS_EACH) -> BradleyTerry:
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = (x - self.mean) / self.sd
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        rng = np.random.default_rng(0)
        a = np.concatenate([np.repeat(good, each), rng.choice(good, each * len(bad))])
        b = np.concatenate([rng.choice(bad, each * len(good)), np.repeat(bad, each)])
        d = z[a] - z[b]
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
            gradient = d.T @ (p - 1) / len(d) + RIDGE * w
            hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        strength = z @ w
        # the sample has the classes in other shares than the table: weigh them back, then take the quantile
        weight = np.where(y == 0, share / max(len(bad), 1), (1 - share) / max(len(good), 1))
        order = np.argsort(strength, kind="stable")
        passed = np.cumsum(weight[order])
        i = int(np.searchsorted(passed, share * (1 - 1e-9)))
        below, above = strength[order[min(i, len(order) - 1)]], strength[order[min(i + 1, len(order) - 1)]]
        self.threshold = (below + above) / 2
        slopes = np.geomspace(0.05, 20, 60)
        margin = (strength - self.threshold)[None, :] * slopes[:, None] + np.log(KEEP / (1 - KEEP))
        loss = (np.logaddexp(0, np.where(y == 1, -margin, margin)) * weight).sum(axis=1)
        self.slope = float(slopes[int(np.argmin(loss))])
        return self

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.sd) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        margin = (self.strengths(x) - self.threshold) * self.slope + np.log(KEEP / (1 - KEEP))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fitted(docs: DataFrame, labels: DataFrame) -> BradleyTerry:
    x, y, share = training_rows(docs, labels)
    if not len(y) or y.min() == y.max():
        return BradleyTerry(float(y[0]) if len(y) else KEEP)
    return BradleyTerry().fit(x, y, share)


def scored(docs: DataFrame, model: BradleyTerry) -> DataFrame:
    """``docs`` with its columns and ``__score``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructType

    names = docs.columns
    out = StructType([*docs.schema.fields]).add("__score", DoubleType())
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch, x in _featured(batches, names.index("text")):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(x))], schema=arrow)

    ready(docs.sparkSession)
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, out)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = scored(docs.select("doc_id", "text"), fitted(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= KEEP).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows below the threshold; columns as they were."""
    rows = scored(docs, fitted(docs, labels))
    return rows.where(F.col("__score") >= KEEP).select(*docs.columns)
