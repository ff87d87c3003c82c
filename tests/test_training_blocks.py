from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmill.functions.hashing import md5_words
from foldmill.operators import dense_net, features
from foldmill.operators.dense_net import BUCKETS, Member, Training


@pytest.mark.parametrize("length", [0, 1, 8, 45, 56, 70, 130])
def test_many_digests_equal_hashlib(length):
    keys = np.random.default_rng(length).integers(0, 256, (7, length)).astype(np.uint8)
    suffixes = [f":{b}".encode() for b in range(12)]
    found = md5_words(b"42:9:", keys, suffixes)
    for s, suffix in enumerate(suffixes):
        for k, key in enumerate(keys):
            assert found[s, :, k].astype("<u4").tobytes() == hashlib.md5(b"42:9:" + key.tobytes() + suffix).digest()


def test_masks_are_the_bits_of_each_key():
    """Null, empty, short, long and non-ASCII keys, in the order in which blocks hold them."""
    keys = [None, "", "7", "8", "\u00e9", "x" * 100, "y" * 100]
    held = [None if k is None else k.encode() for k in keys]
    lengths = np.array([-1 if k is None else len(k) for k in held], np.int16)
    found = dense_net.mask_bits(lengths, np.frombuffer(b"".join(k or b"" for k in held), np.uint8), 42, 3, 18)
    assert found.shape == (18, len(keys))
    for at, key in enumerate(held):
        for unit in range(18):
            text = b":".join([b"42", b"3", *([] if key is None else [key]), str(unit // 8).encode()])
            assert found[unit, at] == int(hashlib.md5(text).hexdigest()[4 * (unit % 8) : 4 * (unit % 8) + 4], 16)


def test_an_epoch_reads_each_row_once():
    """Two and four updates an epoch: four passes whose buckets do not overlap, where the second pass used to read half of the table and a quarter of it again."""
    settings = {0: Training([4], epochs=3, slices=2), 1: Training([4], epochs=3, slices=4), 2: Training([4], epochs=3, slices=3), 3: Training([4], epochs=1)}
    passes = dense_net._epoch_passes(settings, 1)
    read = [set().union(*(set(range(BUCKETS)) if b is None else b for b, _ in shares.values())) for _, shares in passes]
    assert sum(map(len, read)) == BUCKETS == len(set().union(*read))
    assert passes[0][1][3] == (set(), BUCKETS) and all(3 not in shares for _, shares in passes[1:])
    for i in (0, 1, 2):
        at, taken = 0, set()
        for _, shares in passes:
            buckets, end = shares[i]
            taken |= buckets
            if end in settings[i].ends():
                assert sorted(taken) == settings[i].slice_buckets(1, at)
                at, taken = at + 1, set()
        assert at == settings[i].slices and not taken


def test_blocks_hold_the_rows(spark):
    """Rows of many groups, some values whole and some missing, keys of several lengths: each block holds one part and bucket, and no value is lost."""
    rows = [(i, [float(i % 5), i / 7, float("nan") if i % 3 else 1e9], i % 3, i % 4 if i % 9 else None, None if i == 5 else str(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, raw array<double>, y long, part long, key string").withColumn("bucket", F.col("id") % 6)
    for most in (10, 10_000):
        got = []
        for b in dense_net.pack(df.drop("id").coalesce(2), most).collect():
            *raw, y, lengths = dense_net.unpack_block(b["n"], b["kinds"], b["data"])
            at = 0
            for k in range(b["n"]):
                key = None if lengths[k] < 0 else bytes(b["keys"][at : at + lengths[k]]).decode()
                at += max(int(lengths[k]), 0)
                got.append((key or "", key is None, repr([float(c[k]) for c in raw]), int(y[k]), None if b["part"] == dense_net.NO_PART else b["part"], b["bucket"]))
            assert at == len(b["keys"]) and raw[0].dtype == np.int8 and (np.diff(lengths) >= 0).all()
        assert sorted(got, key=str) == sorted(((k or "", k is None, repr(v), y, p, i % 6) for i, v, y, p, k in rows), key=str)


def test_long_vectors_equal_filled_ones():
    """A plan of more slots than are filled in gives the same layers."""
    rng = np.random.default_rng(2)
    wide = features.Rows(rng.normal(size=(50, 2)), [rng.integers(-1, 90, 50), rng.integers(92, 99, 50)], 100)
    wide.slots[0] = np.where(wide.slots[0] >= 0, wide.slots[0] + 2, -1)
    assert wide.width > features.NARROW
    flat, y = dense_net.initial_weights([100, 6, 3], 1), rng.integers(0, 3, 50)
    found, scores = dense_net._gradient(flat, [100, 6, 3], wide, y)
    plain = features.Rows(wide.dense())
    outs = dense_net.probabilities(flat, [100, 6, 3], wide)
    assert outs == pytest.approx(dense_net.probabilities(flat, [100, 6, 3], plain))
    w, b, v, c = flat[:600].reshape(100, 6), flat[600:606], flat[606:624].reshape(6, 3), flat[624:]
    hidden = np.maximum(wide.dense() @ w + b, 0)
    z = np.exp(hidden @ v + c)
    assert outs == pytest.approx(z / z.sum(axis=1, keepdims=True))
    back = (outs - np.eye(3)[y]) @ v.T * (hidden > 0)
    assert found == pytest.approx(np.concatenate([(wide.dense().T @ back).ravel(), back.sum(axis=0), (hidden.T @ (outs - np.eye(3)[y])).ravel(), (outs - np.eye(3)[y]).sum(axis=0)]))
    assert scores[2] == (outs.argmax(axis=1) == y).sum()


def test_of_equal_probabilities_the_first_counts():
    p = np.array([[0.4, 0.4, 0.2], [0.4, 0.4, 0.2], [0.2, 0.4, 0.4], [1 / 3, 1 / 3, 1 / 3]])
    for y in range(3):
        assert dense_net._score(p, np.full(4, y))[2] == (p.argmax(axis=1) == y).sum()


def test_networks_of_one_plan_share_its_view(spark):
    df = spark.range(20).select("id", F.col("id").cast("double").alias("v"), F.concat(F.lit("s"), F.col("id") % 3).alias("s"))
    plan, other = (features.fit_features(df, ["v"], ["s"]) for _ in range(2))
    _, views = features.coded_rows(df, [plan, other, plan])
    assert views[0] is views[2] and views[0] is not views[1]


def test_chunks_of_a_block_add_up_to_its_gradient(monkeypatch):
    """Folds that look at the rows through their own numbers and codes, with missing values and dropout: chunks of any length give the sums of plain gradients."""
    rng = np.random.default_rng(5)
    raw = np.column_stack([rng.normal(50, 9, 900), np.where(rng.random(900) < 0.2, np.nan, rng.normal(size=900)), rng.integers(-2, 4, 900), rng.integers(-2, 3, 900)])
    y, keys = rng.integers(0, 3, 900), [str(i) for i in range(900)]
    views = [features.View(np.arange(2), np.array([50.0 + f, 0.1]), np.array([9.0, 1 + f]), [(2 + f, features.CodeSlots(2, f, 1))], 6) for f in (0, 1)]
    members = [Member(views[0], 3, Training([5, 4]), (0,)), Member(views[1], 3, Training([6], dropout=0.25, slices=2), (1,)), Member(views[0], 3, Training([7]), (1,))]
    block = dense_net._block((0, 0), raw, y, dense_net.pa.array([k.encode() for k in keys]))
    order = np.argsort([len(k) for k in keys], kind="stable")
    bits = np.array([[int(hashlib.md5(f"42:0:{k}:0".encode()).hexdigest()[4 * u : 4 * u + 4], 16) for u in range(6)] for k in np.array(keys)[order]])
    for values in (1, 700, 1 << 20):
        monkeypatch.setattr(dense_net, "CHUNK", 1)
        monkeypatch.setattr(dense_net, "CHUNK_VALUES", values * 7)
        shares = [dense_net._Share(m, dense_net.initial_weights(m.layers, 42), 0, True, None) for m in members]
        dense_net._see(shares, 0, block)
        for share, m in zip(shares, members):
            flat, x = dense_net.initial_weights(m.layers, 42), m.view.vectors(raw)
            if m.held == (0,):
                assert share.scores[3:] == pytest.approx(dense_net._score(dense_net.probabilities(flat, m.layers, x), y)) and not share.total.any()
                continue
            masks = [(bits >= 0.25 * 65536) / 0.75] if m.setting.dropout else []
            at = order if masks else slice(None)
            total, scores = dense_net._gradient(flat, m.layers, x[at], y[at], masks)
            assert share.total == pytest.approx(total, abs=1e-9) and share.scores[:3] == pytest.approx(scores)


def test_chunks_follow_the_widest_layer():
    """Calls of numpy cost as much as the work on a thousand rows of a narrow network."""
    seen = []

    class Looking(features.View):
        def rows(self, raw):
            seen.append(len(raw[0]))
            return super().rows(raw)

    n = dense_net.BLOCK
    block = dense_net._block((0, 0), np.zeros((n, 1)), np.zeros(n, int), dense_net.pa.array([b"k"] * n))
    for hidden, longest in (([10, 8], 4096), ([96], 1024)):
        seen.clear()
        member = Member(Looking(np.arange(1), np.zeros(1), np.ones(1), [], 1), 3, Training(hidden))
        dense_net._see([dense_net._Share(member, dense_net.initial_weights(member.layers, 1), 0, True, None)], 0, block)
        assert max(seen) == longest and sum(seen) == n
