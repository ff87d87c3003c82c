"""Small dense classifiers (ReLU layers, softmax output) trained by Spark jobs.

An epoch makes ``Training.slices`` updates, by SGD or Adam, each with the exact gradient over the rows of one slice that are not held out. With one
slice that is the whole table. The slices of an epoch are drawn anew from seed and epoch: a row lies in one of ``BUCKETS`` by a hash of its key, and
an epoch deals the buckets to its slices in the order of a hash. Their number never follows from rows, tasks or cores, so neither does the result (but for the last
digits of sums). Rows are stored by bucket, and a pass reads the buckets of its slice only. Where libraries take one update per 32 rows, this takes a few per
epoch, so it learns with larger steps: see ``Training.rate``.

Rows are stored in blocks, a column of numbers after the other (see :func:`pack`), so a pass moves bytes rather than values. A block's rows share bucket and part.

Dropout masks hidden units of train rows and scales the others up; scoring uses all units. Whether a unit is kept is read off
``md5(seed:epoch:key:block)``, 16 bits a unit and 8 units a block, so it depends on nothing else (a row meets one slice in an epoch).

Several networks are trained by the same passes: the folds of a cross-validation or the trials of a search
differ in their features, settings and held-out rows, but read the same stored rows. So five folds of fifty epochs cost
fifty passes over the table, not two hundred and fifty. Networks with different numbers of slices (and one seed) share an epoch's passes: those are cut wherever one of
them ends a slice, the others add up their gradients until their own slice ends, and so an epoch reads every row once.

The job of one pass returns, per network, sums of the length of its weights, added up on the executors; only those
reach the driver, and the weights travel back with the next job. The model family, loss and update rule are those of the
usual libraries; the trained weights are not, since the order of updates differs.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasProbabilityCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmill.functions.hashing import draw, hash32, md5_words
from foldmill.operators.evaluate import PROBABILITY_FLOOR, EarlyStop
from foldmill.operators.features import Rows, View
from foldmill.session import checkpoint, new_folder, remove_folder
from foldmill.sources import files

# Adam's usual settings (fixed values).
ADAM_DECAY_1, ADAM_DECAY_2, ADAM_EPSILON = 0.9, 0.999, 1e-7
#: Rows are stored in so many buckets by key; an epoch has this many slices at most.
BUCKETS = 48
UNITS_PER_BLOCK = 8
#: The sums of so many tasks are added up in one level.
FEW_SHARDS = 64


def weight_count(layers: Sequence[int]) -> int:
    return sum((i + 1) * o for i, o in zip(layers, layers[1:]))


def initial_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform Glorot weights and zero biases, as one flat vector."""
    rng = np.random.default_rng(seed)
    parts = []
    for i, o in zip(layers, layers[1:]):
        reach = np.sqrt(6.0 / (i + o))
        parts += [rng.uniform(-reach, reach, i * o), np.zeros(o)]
    return np.concatenate(parts)


def _unpack(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for i, o in zip(layers, layers[1:]):
        out.append((flat[at : at + i * o].reshape(i, o), flat[at + i * o : at + (i + 1) * o]))
        at += (i + 1) * o
    return out


def probabilities(flat: np.ndarray, layers: Sequence[int], x: Rows | np.ndarray) -> np.ndarray:
    return _forward(_unpack(flat, layers), x if isinstance(x, Rows) else Rows(x))[-1].T


def _forward(weights, x: Rows, masks: Sequence[np.ndarray] = ()) -> list:
    """The rows, then each layer's outputs with a row for each unit; so do the masks lie here."""
    outs: list = [x]
    for depth, (w, b) in enumerate(weights):
        z = w.T @ outs[-1] + b[:, None] if depth else x.through(w, b)
        if depth < len(weights) - 1:
            np.maximum(z, 0.0, out=z)
            if len(masks):
                z *= masks[depth]
        else:
            z -= z.max(axis=0)
            np.exp(z, out=z)
            z /= z.sum(axis=0)
        outs.append(z)
    return outs


def _score(p: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Rows, summed loss and hits."""
    p = np.ascontiguousarray(p.T)
    own = p.reshape(-1)[y * len(y) + np.arange(len(y))]
    hit = own == p.max(axis=0)
    for c in range(len(p) - 1):  # of equal ones the first class is the prediction
        hit &= (p[c] < own) | (y <= c)
    return float(len(y)), float(-np.log(np.maximum(own, PROBABILITY_FLOOR)).sum()), float(hit.sum())


def _add_gradient(total: np.ndarray, flat: np.ndarray, layers, x: Rows, y: np.ndarray, masks: Sequence[np.ndarray] = ()) -> tuple[float, float, float]:
    """Add the gradient of the summed cross-entropy to ``total``; returns the scores at the given weights, both behind the masks of the hidden layers."""
    weights, sums = _unpack(flat, layers), _unpack(total, layers)
    outs = _forward(weights, x, masks)
    scores = _score(outs[-1].T, y)
    delta = outs[-1]
    delta.reshape(-1)[y * len(y) + np.arange(len(y))] -= 1.0
    for depth in range(len(weights) - 1, 0, -1):
        w, b = sums[depth]
        w += outs[depth] @ delta.T
        b += delta.sum(axis=1)
        delta = weights[depth][0] @ delta
        delta *= outs[depth] > 0
        if len(masks):
            delta *= masks[depth - 1]
    x.add_back(delta, *sums[0])
    return scores


def _gradient(flat, layers, x: Rows | np.ndarray, y, masks: Sequence[np.ndarray] = ()) -> tuple[np.ndarray, tuple[float, float, float]]:
    """The gradient and the scores of :func:`_add_gradient`, for masks with a row for each row of ``x``."""
    total = np.zeros(len(flat))
    return total, _add_gradient(total, flat, layers, x if isinstance(x, Rows) else Rows(x), y, [m.T for m in masks])


@dataclass
class Updater:
    """SGD or Adam on a flat state vector: the weights, and for Adam both moments and the step count."""

    kind: str
    rate: float
    size: int

    def start(self, weights: np.ndarray) -> np.ndarray:
        if self.kind == "sgd":
            return weights.copy()
        return np.concatenate([weights, np.zeros(2 * self.size + 1)])

    def apply(self, state: np.ndarray, gradient: np.ndarray) -> None:
        n = self.size
        if self.kind == "sgd":
            state[:n] -= self.rate * gradient
            return
        first, second = state[n : 2 * n], state[2 * n : 3 * n]
        state[-1] += 1
        first += (1 - ADAM_DECAY_1) * (gradient - first)
        second += (1 - ADAM_DECAY_2) * (gradient**2 - second)
        scale = np.sqrt(1 - ADAM_DECAY_2 ** state[-1]) / (1 - ADAM_DECAY_1 ** state[-1])
        state[:n] -= self.rate * scale * first / (np.sqrt(second) + ADAM_EPSILON)


@dataclass
class Training:
    """Settings of one network; ``hidden`` are the sizes between the features and the classes. ``rate`` suits one update an epoch.

    ``slices`` is the number of updates an epoch makes, ``dropout`` the share of hidden units that a train row does without.
    """

    hidden: list[int]
    epochs: int = 50
    rate: float = 0.05
    optimizer: str = "adam"
    patience: int | None = None
    seed: int = 42
    slices: int = 1
    dropout: float = 0.0

    def __post_init__(self):
        if not 1 <= self.slices <= BUCKETS or not 0.0 <= self.dropout < 1.0:
            raise ValueError(f"slices must lie in 1..{BUCKETS}, dropout in [0, 1)")

    def slice_buckets(self, epoch: int, step: int) -> list[int]:
        """The buckets of one slice of an epoch."""
        order = bucket_order(self.seed, epoch)
        return sorted(b for place, b in enumerate(order) if place * self.slices // BUCKETS == step)

    def ends(self) -> list[int]:
        """The places in an epoch's order of buckets at which its slices end."""
        return [-(-BUCKETS * step // self.slices) for step in range(1, self.slices + 1)]


@dataclass
class Member:
    """One network of a joint training: its features, its settings, and the parts it is only scored on."""

    view: View
    classes: int
    setting: Training
    held: tuple[int, ...] = ()

    @property
    def layers(self) -> list[int]:
        return [self.view.width, *self.setting.hidden, self.classes]

    @property
    def updater(self) -> Updater:
        return Updater(self.setting.optimizer, self.setting.rate, weight_count(self.layers))


@dataclass
class Fitted:
    layers: list[int]
    weights: np.ndarray
    history: list[dict] = field(default_factory=list)
    best_epoch: int = 0
    held_rows: int = 0
    train_rows: int = 0
    updates: int = 0

    def model(self, **cols) -> "DenseNetModel":
        return DenseNetModel(layers=self.layers, weights=[float(w) for w in self.weights], **cols)


def bucket_order(seed: int, epoch: int) -> list[int]:
    return sorted(range(BUCKETS), key=lambda b: (draw(seed, f"slice{epoch}", b), b))


def bucket(key: str) -> Column:
    return hash32(key, "bucket") % BUCKETS


def mask_bits(lengths: np.ndarray, keys: np.ndarray, seed: int, epoch: int, units: int) -> np.ndarray:
    """16 random bits for each of ``units`` hidden units (rows) and each key, from ``md5(seed:epoch:key:block)``.

    ``keys`` holds the bytes of all keys, one after the other; runs of keys of one ``length`` are hashed together. A null key (length -1) is left out of the text.
    """
    blocks, at, found = [f":{b}".encode() for b in range(-(-units // UNITS_PER_BLOCK))], 0, []
    borders = np.flatnonzero(np.diff(lengths)) + 1
    for first, end in zip([0, *borders], [*borders, len(lengths)]):
        count, size = end - first, max(int(lengths[first]), 0)
        prefix = f"{seed}:{epoch}" if lengths[first] < 0 else f"{seed}:{epoch}:"
        found.append(md5_words(prefix.encode(), keys[at : at + count * size].reshape(count, size), blocks))
        at += count * size
    words = np.concatenate(found, axis=2)
    words = (words & 0x00FF00FF) << 8 | words >> 8 & 0x00FF00FF  # a unit's bits are big-endian
    bits = np.empty((len(blocks), 4, 2, len(lengths)), np.uint16)
    bits[:, :, 0], bits[:, :, 1] = words & 0xFFFF, words >> 16
    return bits.reshape(-1, len(lengths))[:units]


#: Rows of a stored block.
BLOCK = 8192
#: Rows are computed in chunks of so many, or of so many values of the widest layer: enough that calls of numpy cost little, few enough for the caches.
CHUNK, CHUNK_VALUES = 1024, 40_960
#: Rows that a task holds back until their blocks are full.
WAITING = 50 * BLOCK
NO_PART = np.iinfo(np.int64).min
PACKED = "part long, n int, kinds string, data binary, keys binary"


def _narrowed(column: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them all."""
    if len(column) and np.isfinite(column).all():
        low, high = column.min(), column.max()
        for kind in (np.int8, np.int16, np.int32):
            limits = np.iinfo(kind)
            if limits.min <= low and high <= limits.max:
                whole = column.astype(kind)
                if (whole == column).all():
                    return whole
                break
    return column


def _block(group: tuple[int, int], raw: np.ndarray, y: np.ndarray, keys: pa.Array | None) -> dict:
    columns, data = [*raw.T, y], b""
    if keys is not None:
        lengths = pc.fill_null(pc.binary_length(keys), -1).to_numpy()
        order = np.argsort(lengths, kind="stable")  # keys of one length are hashed together
        columns, keys = [c[order] for c in (*columns, lengths)], keys.take(pa.array(order))
        _, ends, held = keys.buffers()
        ends = np.frombuffer(ends, np.int32)[keys.offset : keys.offset + len(keys) + 1]
        data = held[int(ends[0]) : int(ends[-1])].to_pybytes() if held else b""
    columns = [_narrowed(np.ascontiguousarray(c)) for c in columns]
    padded = b"".join(c.tobytes() + bytes(-c.nbytes % 8) for c in columns)
    return {"part": group[1], "n": len(y), "kinds": "".join(c.dtype.char for c in columns), "data": padded, "keys": data, "bucket": group[0]}


def unpack_block(n: int, kinds: str, data) -> list[np.ndarray]:
    """A block's columns: the raw values, the target and, if keys are stored, their lengths."""
    columns, at = [], 0
    for kind in kinds:
        columns.append(np.frombuffer(data, kind, n, at))
        at += -(-columns[-1].nbytes // 8) * 8
    return columns


def pack(rows: DataFrame, most: int = WAITING) -> DataFrame:
    """Rows (raw, y, part, and key and bucket if need be) as blocks of at most ``BLOCK`` rows that share bucket and part, each column in the smallest type that holds it.

    A task holds back ``most`` rows and those of one Arrow batch at most; if its rows are of more groups than that fills, the blocks are smaller.
    """
    keyed, bucketed = "key" in rows.columns, "bucket" in rows.columns
    schema = PACKED + (", bucket long" if bucketed else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = pa.schema([(c, {"n": pa.int32(), "kinds": pa.string(), "data": pa.binary(), "keys": pa.binary()}.get(c, pa.int64())) for c in names])

    def work(batches):
        waiting: dict[tuple[int, int], list] = {}
        counts: dict[tuple[int, int], int] = {}

        def blocks(group, whole: bool):
            """The group's full blocks, and with ``whole`` what is left."""
            parts = waiting.pop(group)
            raw, y = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            keys = pa.concat_arrays([p[2] for p in parts]) if keyed else None
            end = len(y) if whole else len(y) // BLOCK * BLOCK
            for at in range(0, end, BLOCK):
                to = min(at + BLOCK, end)
                found = _block(group, raw[at:to], y[at:to], keys[at:to] if keyed else None)
                yield pa.RecordBatch.from_pylist([{c: found[c] for c in names}], types)
            counts[group] = len(y) - end
            if end < len(y):
                waiting[group] = [(raw[end:], y[end:], keys[end:] if keyed else None)]

        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column("raw").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            y = b.column("y").to_numpy(zero_copy_only=False)
            part = pc.fill_null(b.column("part"), NO_PART).to_numpy(zero_copy_only=False)
            own = b.column("bucket").to_numpy(zero_copy_only=False) if bucketed else np.zeros(b.num_rows, np.int64)
            keys = b.column("key").cast(pa.binary()) if keyed else None
            order = np.lexsort((part, own))
            borders = np.flatnonzero(np.diff(own[order]) | np.diff(part[order])) + 1
            for at in np.split(order, borders):
                group = int(own[at[0]]), int(part[at[0]])
                waiting.setdefault(group, []).append((raw[at], y[at], keys.take(pa.array(at)) if keyed else None))
                counts[group] = counts.get(group, 0) + len(at)
                if counts[group] >= BLOCK:
                    yield from blocks(group, False)
            while sum(counts.values()) > most:
                yield from blocks(max(waiting, key=lambda g: counts[g]), True)
        for group in list(waiting):
            yield from blocks(group, True)

    return rows.mapInArrow(work, schema)


def training_rows(
    df: DataFrame, raw: str, target: str, part: Column, key: str, tasks: int | None = None, members: Sequence[Member] = ()
) -> DataFrame:
    """The rows the passes read, in blocks: raw features, target and part, spread over tasks by key.

    For members that make one update an epoch they are stored by ``checkpoint``, so that a pass reads finished partitions and a lost executor costs no re-preparation.
    If one has slices or dropout they are written as a table partitioned by bucket (and with their keys), to be removed by :func:`discard_rows`.
    ``tasks`` defaults to the session's shuffle partitions; it changes how the work is spread, not the result.
    """
    rows = df.select(
        F.col(raw).alias("raw"), F.col(target).cast("long").alias("y"), part.cast("long").alias("part"),
        F.col(key).cast("string").alias("key"),
    )
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if all(m.setting.slices == 1 and not m.setting.dropout for m in members):
        return checkpoint(pack(rows.repartition(tasks, "key").drop("key")))
    # so many pieces that all tasks have a bucket's piece to write, whatever their number
    piece = F.pmod(F.xxhash64("key"), F.lit(-(-tasks // BUCKETS)))
    path = new_folder(spark, "training")
    blocks = pack(rows.withColumn("bucket", bucket("key")).repartition(tasks, F.col("bucket"), piece))
    blocks.write.partitionBy("bucket").option("compression", "none").parquet(path)
    stored = spark.read.schema(blocks.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard_rows(rows: DataFrame) -> None:
    path = getattr(rows, "stored_at", None)
    if path:
        remove_folder(rows.sparkSession, path)


class _Share:
    """One network's work on one task's rows during one pass."""

    def __init__(self, member: Member, state: np.ndarray, epoch: int, first: bool, buckets: set[int] | None):
        self.member, self.layers = member, member.layers
        setting, size = member.setting, weight_count(self.layers)
        self.scoring, self.learning, self.buckets = first, epoch < setting.epochs, buckets
        self.weights, self.total, self.scores = state[:size], np.zeros(size), np.zeros(6)

    def scores_block(self, part: int) -> bool:
        return self.scoring and part in self.member.held

    def learns_block(self, bucket: int | None, part: int) -> bool:
        return self.learning and part not in self.member.held and (self.buckets is None or bucket in self.buckets)

    def masks(self, drawn: np.ndarray) -> list[np.ndarray]:
        """Factors of the hidden units, from 16 bits for each."""
        setting = self.member.setting
        kept = (drawn[: sum(setting.hidden)] >= setting.dropout * 65536) * (1 / (1 - setting.dropout))
        return np.split(kept, np.cumsum(setting.hidden)[:-1])

    def score(self, x: Rows, y: np.ndarray) -> None:
        self.scores[3:] += _score(probabilities(self.weights, self.layers, x), y)

    def learn(self, x: Rows, y: np.ndarray, drawn: dict[int, np.ndarray]) -> None:
        setting = self.member.setting
        masks = self.masks(drawn[setting.seed]) if setting.dropout else ()
        self.scores[:3] += _add_gradient(self.total, self.weights, self.layers, x, y, masks)

    def sums(self) -> np.ndarray:
        """Six scores (train, then held-out rows), then the summed gradient."""
        return np.concatenate([self.scores, self.total])


def _see(runs: Sequence[_Share], epoch: int, block: dict) -> None:
    """Show a block to the networks that score or learn it, a chunk at a time."""
    scoring = [r for r in runs if r.scores_block(block["part"])]
    learning = [r for r in runs if r.learns_block(block.get("bucket"), block["part"])]
    if not scoring and not learning:
        return
    columns = unpack_block(block["n"], block["kinds"], block["data"])
    units: dict[int, int] = {}
    for r in learning:
        setting = r.member.setting
        if setting.dropout:
            units[setting.seed] = max(units.get(setting.seed, 0), sum(setting.hidden))
    if "bucket" in block:  # stored with keys
        lengths, keys = columns.pop(), np.frombuffer(block["keys"], np.uint8)
        ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0), dtype=np.int64)])
    *raw, y = columns
    y = y.astype(np.int64)
    views = {id(r.member.view): r.member.view for r in (*scoring, *learning)}
    size = max(CHUNK, CHUNK_VALUES // max(max(r.layers[1:]) for r in (*scoring, *learning)))
    for at in range(0, block["n"], size):
        to = min(at + size, block["n"])
        drawn = {seed: mask_bits(lengths[at:to], keys[ends[at] : ends[to]], seed, epoch, n) for seed, n in units.items()}
        chunk = [c[at:to] for c in raw]
        for view in views.values():  # one view's vectors at a time, while they are in the caches
            x = view.rows(chunk)
            for r in scoring:
                if r.member.view is view:
                    r.score(x, y[at:to])
            for r in learning:
                if r.member.view is view:
                    r.learn(x, y[at:to], drawn)


def _one_pass(
    rows: DataFrame, active: dict[int, tuple[Member, np.ndarray, set[int] | None]], epoch: int, first: bool, fan: int
) -> dict[int, np.ndarray]:
    """Run one pass for the active networks, each with the buckets it learns from; returns each one's sums.

    The first pass of an epoch scores the held-out rows, and a network's pass after its last epoch does nothing else.
    """
    if "bucket" in rows.columns:
        wanted = set().union(*(range(BUCKETS) if b is None else b for m, _, b in active.values() if epoch < m.setting.epochs))
        needed = F.col("bucket").isin(sorted(wanted))
        if first:
            needed = needed | F.col("part").isin(sorted({h for m, _, _ in active.values() for h in m.held}))
        rows = rows.filter(needed) if len(wanted) < BUCKETS else rows

    def work(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        runs = {i: _Share(member, state, epoch, first, buckets) for i, (member, state, buckets) in active.items()}
        for b in batches:
            fields = {name: b.column(name).to_pylist() for name in b.schema.names if name not in ("data", "keys")}
            for at in range(b.num_rows):
                block = {name: values[at] for name, values in fields.items()}
                _see(list(runs.values()), epoch, block | {name: b.column(name)[at].as_buffer() for name in ("data", "keys")})
        for i, run in runs.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int64()), pa.array([shard], pa.int64()), pa.array([run.sums()], pa.list_(pa.float64()))],
                ["member", "shard", "sums"],
            )

    parts = rows.mapInArrow(work, "member long, shard long, sums array<double>")
    # Added up in two levels if there are many, so that neither one task nor the driver receives a vector per shard.
    sums = parts.select("member", (F.col("shard") % fan).alias("g"), array_to_vector("sums").alias("v"))
    if fan > 1:
        sums = sums.groupBy("member", "g").agg(Summarizer.sum(F.col("v")).alias("v"))
    sums = sums.groupBy("member").agg(Summarizer.sum(F.col("v")).alias("v"))
    return {r["member"]: r["v"].toArray() for r in sums.collect()}


class _Progress:
    """The driver's side of one network: its state between passes, its history and its best weights."""

    def __init__(self, member: Member):
        self.member, self.size = member, weight_count(member.layers)
        self.state = member.updater.start(initial_weights(member.layers, member.setting.seed))
        self.history: list[dict] = []
        self.stop, self.best = EarlyStop(member.setting.patience), self.state[: self.size].copy()
        self.held_rows = self.train_rows = self.updates = 0
        self.seen, self.pending = np.zeros(3), np.zeros(1 + self.size)
        self.done = False

    def take(self, epoch: int, first: bool, end: int, sums: np.ndarray) -> None:
        """The sums of a pass that ends at the place ``end`` of the epoch's order of buckets."""
        setting = self.member.setting
        if first:
            held_n, held_loss, held_hits = (float(v) for v in sums[3:6])
            self.held_rows, self.seen = round(held_n), np.zeros(3)
            if epoch and held_n:
                val_loss = held_loss / held_n
                self.history[-1] |= {"val_loss": val_loss, "val_accuracy": held_hits / held_n}
                if self.stop.see(epoch - 1, val_loss):
                    self.best = self.state[: self.size].copy()
                elif self.stop.stopped:
                    self.done = True
                    return
        if epoch == setting.epochs:
            self.done = True
            return
        self.seen += sums[:3]
        self.pending += np.concatenate([sums[:1], sums[6:]])
        if end not in setting.ends():
            return
        if self.pending[0]:
            self.member.updater.apply(self.state, self.pending[1:] / self.pending[0])
            self.updates += 1
        self.pending = np.zeros(1 + self.size)
        if end == BUCKETS:
            n, loss, hits = (float(v) for v in self.seen)
            if n == 0:
                raise ValueError("no rows to train on")
            self.train_rows = round(n)
            self.history.append({"step": epoch, "loss": loss / n, "accuracy": hits / n})
            # Without held-out rows there is nothing to score after the last epoch.
            self.done = epoch == setting.epochs - 1 and not self.held_rows

    def saved(self) -> dict:
        """Everything the next epoch depends on; numbers survive JSON to the last bit."""
        return {
            "member": [self.member.layers, asdict(self.member.setting), list(self.member.held)], "state": self.state.tolist(), "best": self.best.tolist(),
            "stop": [self.stop.best_step, self.stop.best_loss, self.stop.stopped], "history": self.history, "done": self.done,
            "counts": [self.held_rows, self.train_rows, self.updates],
        }

    def restore(self, saved: dict) -> None:
        if saved["member"] != json.loads(json.dumps(self.saved()["member"])):
            raise ValueError("the saved state is that of another network")
        self.state, self.best, self.history, self.done = np.array(saved["state"]), np.array(saved["best"]), saved["history"], saved["done"]
        self.stop.best_step, self.stop.best_loss, self.stop.stopped = saved["stop"]
        self.held_rows, self.train_rows, self.updates = saved["counts"]

    def fitted(self) -> Fitted:
        if self.member.setting.patience and self.stop.best_step is not None:
            weights, epoch = self.best, self.stop.best_step
        else:
            weights, epoch = self.state[: self.size].copy(), len(self.history) - 1
        return Fitted(self.member.layers, weights, self.history, epoch, self.held_rows, self.train_rows, self.updates)


def _epoch_passes(settings: dict[int, Training], epoch: int) -> list[tuple[bool, dict[int, tuple[set[int] | None, int]]]]:
    """The passes of an epoch: whether it is the first, and for each network that takes part the buckets it learns from (None: all) and the place at which they end.

    Networks of one seed go through the buckets in the same order, so their passes are cut at the ends of all their slices and each row is read once.
    """
    cuts: dict[int, set[int]] = {}
    for s in settings.values():
        if epoch < s.epochs:
            cuts.setdefault(s.seed, set()).update(s.ends())
    passes: list[tuple[bool, dict]] = [(True, {})]
    for i, s in settings.items():
        if epoch >= s.epochs:  # scored once more
            passes[0][1][i] = (set(), BUCKETS)
            continue
        order, start = bucket_order(s.seed, epoch), 0
        for step, end in enumerate(sorted(cuts[s.seed])):
            if step == len(passes):
                passes.append((False, {}))
            passes[step][1][i] = (None if end - start == BUCKETS else set(order[start:end]), end)
            start = end
    return passes


def train(rows: DataFrame, members: Sequence[Member], state: str | None = None, most: int | None = None) -> list[Fitted]:
    """Train all members on rows from :func:`training_rows`.

    The held-out scores of an epoch are taken by the pass that follows it, which starts from the weights that epoch
    ended with; so ``epochs`` epochs of one slice cost ``epochs + 1`` passes, not twice as many. With ``patience`` the best
    held-out loss decides which weights are kept. Members that are done leave the passes to the others.

    With ``state``, a folder all drivers share, each finished epoch is committed there (weights, moments, stop rule, history), and a call that finds one
    goes on behind it: a driver that was lost costs the epoch it was in. ``most`` ends a call after so many epochs, to be resumed.
    """
    spark, shards = rows.sparkSession, rows.rdd.getNumPartitions()
    fan = int(shards**0.5) if shards > FEW_SHARDS else 1
    progress, start = [_Progress(m) for m in members], 0
    if state and (found := files.newest(spark, state)):
        saved = json.loads(found[1])
        if len(saved) != len(progress):
            raise ValueError("the saved state is that of another training")
        start = int(found[0].split(".")[0]) + 1
        for p, one in zip(progress, saved):
            p.restore(one)
    last = max(m.setting.epochs for m in members)
    for epoch in range(start, last + 1 if most is None else min(last + 1, start + most)):
        if all(p.done for p in progress):
            break
        for first, shares in _epoch_passes({i: p.member.setting for i, p in enumerate(progress) if not p.done}, epoch):
            active = {i: (progress[i].member, progress[i].state, buckets) for i, (buckets, _) in shares.items() if not progress[i].done}
            found = _one_pass(rows, active, epoch, first, fan) if active else {}
            for i in active:  # no task runs, and no sums come, where a slice has no rows at all
                progress[i].take(epoch, first, shares[i][1], found.get(i, np.zeros(6 + progress[i].size)))
        if state:
            files.create(spark, f"{state}/{epoch:06d}.json", json.dumps([p.saved() for p in progress]))
            if epoch:
                files.remove(spark, f"{state}/{epoch - 1:06d}.json")
    return [p.fitted() for p in progress]


class DenseNetModel(Model, HasFeaturesCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """The trained network as a pipeline stage: adds an ``array<double>`` of class probabilities."""

    layers = Param(Params._dummy(), "layers", "layer sizes", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "flat weights", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, layers=None, weights=None, featuresCol="features", probabilityCol="probability"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layers = self.getOrDefault(self.layers)
        flat = np.array(self.getOrDefault(self.weights))

        @F.arrow_udf("array<double>")
        def predict(features: pa.Array) -> pa.Array:
            x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), layers[0])
            p = probabilities(flat, layers, x)
            ends = np.arange(0, p.size + 1, layers[-1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))

        return dataset.withColumn(self.getProbabilityCol(), predict(vector_to_array(self.getFeaturesCol())))


def history_rows(spark, fitted: Fitted) -> DataFrame:
    """One row per epoch; bounded by the number of epochs."""
    rows = [
        (h["step"], h["loss"], h["accuracy"], h.get("val_loss"), h.get("val_accuracy")) for h in fitted.history
    ]
    return spark.createDataFrame(
        rows, "step long, train_loss double, train_accuracy double, val_loss double, val_accuracy double"
    )
