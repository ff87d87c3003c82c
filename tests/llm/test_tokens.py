"""Encoder, token files and separator scan against the library and plain Python."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmill.llm import ans, separators, tokens

TEXTS = [
    "", None, " \n\t ", "Hello, World! It's a test; don't.", "ÉTÉ été É É naïve ß İstanbul ΣΑΣ ς", "a\tb c d", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|> <| endoftext|>", "x1y22 3.14 +1 (23)", "!!! ... .,.,\n\n,,a,,b", "漢字かな 한국어 ไทย",
    "word " * 3000, "́ é", "it''s '' 's 'S", "🙂🙂 👨‍👩‍👧", "\"quoted\" \" \"", "ǅ ǆ Ⱥ ⱥ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


def test_encoder_equals_library(library, spark, sf_dir):
    texts = [t or "" for t in TEXTS] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    coder = tokens.WordEncoder(tokens.default_path(), remembered=500)
    for part in (texts, texts[::-1], texts[:3]):
        ids, n = coder.encode(part)
        ends = np.cumsum(n)
        for text, a, b in zip(part, ends - n, ends):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 70_000])
def test_block_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
    counts = np.bincount(ids, minlength=5001)
    table = ans.Table.of(counts)
    assert n == 0 or int(table.frequencies.sum()) == 1 << table.bits
    coder = ans.Coder(table, lanes=64, every=8)
    block = {"n_tokens": n, **coder.encode(ids)}
    assert coder.decode(block).tolist() == ids.tolist()
    for first, at, states in coder.checkpoints(block) if n else ():
        assert coder.decode_from(block, first, at, states, first + 8).tolist() == ids[first * 64 : (first + 8) * 64].tolist()


def test_many_rare_ids_fit_the_table():
    counts = np.ones(50_000, np.int64)
    counts[7] = 10**12
    table = ans.Table.of(counts)
    assert int(table.frequencies.sum()) == 1 << table.bits and table.frequencies.min() == 1


def test_damage_is_noticed():
    ids = np.arange(500, dtype=np.uint32)
    coder = ans.Coder(ans.Table.of(np.bincount(ids)))
    block = {"n_tokens": 500, **coder.encode(ids)}
    block["crc32"] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(block)


def test_files_hold_every_document_in_order(spark, make, library):
    rows = [(i // 2 if i % 5 else None, t, "clash") for i, t in enumerate(TEXTS * 2)]
    docs = make(rows, "doc_id long, text string, start string")
    found = ans.token_documents(docs, with_ids=True).orderBy("start").collect()
    start = 0
    for row in found:
        ids = [i for i in row.ids]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    order = [(-1 if r.doc_id is None else r.doc_id) for r in found]
    assert order == sorted(order)
    want = sorted((str(d), library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, _ in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in found) == want


def test_empty_table(make):
    docs = make([], "doc_id long, text string")
    assert ans.token_documents(docs).count() == 0
    assert separators.document_counts(docs).count() == 0


def test_blocks_split_long_runs_of_documents(spark, make):
    docs = make([(i, "alpha beta gamma " * 50) for i in range(40)], "doc_id long, text string").coalesce(1)
    raw = ans.raw_blocks(docs, tokens.default_path(), 1, most=400)
    assert raw.where("ids is not null").count() >= 13


def test_separator_scan_equals_plain_loop(spark):
    rng = np.random.default_rng(0)
    rows, want = [], []
    for f in range(6):
        n = int(rng.integers(0, 3000))
        ids = rng.integers(0, 12 if f % 2 else 400, n).astype("<u2")
        start = 0
        for ordinal, end in enumerate([*(np.flatnonzero(ids == 7) + 1).tolist(), n]):
            if end > start:
                want.append((f, ordinal, start, end - start, bool(ids[end - 1] == 7)))
            start = end
        at = block = 0
        while at < n or block == 0:
            k = int(rng.integers(0, 60))
            rows.append((f, block, bytearray(ids[at : at + k].tobytes()) if k else None))
            at, block = at + k, block + 1
    got = separators.token_counts(spark.createDataFrame(rows, "file int, block long, ids binary"), 7, span=4).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_flat_files_count_by_separators(spark, sf_dir, library, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in separators.document_counts(docs).collect()}
    assert got == {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}


def test_real_flat_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([5, 7, 1, 2, 7, 3], "<u4").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = separators.read_flat_files(spark, str(tmp_path), block_bytes=8)
    got = sorted((r.ordinal, r.start, r.n_tokens, r.complete) for r in separators.token_counts(blocks, 7, "<u4").collect())
    assert got == [(0, 0, 2, True), (1, 2, 3, True), (2, 5, 1, False)]


def test_byte_ranges_equal_a_plain_loop(spark, tmp_path):
    rng = np.random.default_rng(3)
    want = []
    for name, n, wide in (("a", 0, 50), ("b", 1, 50), ("c", 40_000, 50), ("d", 40_000, 60_000), ("e", 4096, 8)):
        ids = rng.integers(0, wide, n).astype("<u2")
        (tmp_path / f"{name}.ids").write_bytes(ids.tobytes())
        start = 0
        for ordinal, end in enumerate([*(np.flatnonzero(ids == 7) + 1).tolist(), n]):
            if end > start:
                want.append((f"{name}.ids", ordinal, start, end - start, bool(ids[end - 1] == 7)))
            start = end
    for block_bytes in (64, 8192, 1 << 20):
        blocks = separators.read_flat_files(spark, str(tmp_path), block_bytes)
        got = separators.token_counts(blocks, 7, span=16).collect()
        assert sorted((r.file.rsplit("/", 1)[1], *r[1:]) for r in got) == sorted(want)
    assert separators.read_flat_files(spark, str(tmp_path), 64).rdd.getNumPartitions() > 1


def test_ranges_hold_whole_ids(spark, tmp_path):
    (tmp_path / "a.ids").write_bytes(b"123")
    with pytest.raises(ValueError):
        separators.read_flat_files(spark, str(tmp_path), 9)
    with pytest.raises(Exception):
        separators.token_counts(separators.read_flat_files(spark, str(tmp_path)), 7).collect()


def test_files_of_lost_attempts_are_not_read(spark, make, tmp_path):
    docs = make([(i, "one two three") for i in range(30)], "doc_id long, text string").withColumn("ids", F.lit(b"x")).withColumn("file", F.lit(5))
    written, end_id = separators.write_flat_files(docs, str(tmp_path))
    (tmp_path / "000000-lost.ids").write_bytes(b"12")
    files = written.where("path is not null").select("file", "path", "length")
    got = separators.file_counts(files, end_id, block_bytes=8).collect()
    assert sorted(got) == sorted(separators.token_counts(separators.read_ranges(files, 8), end_id).collect())
    assert len(got) == 30 and len({r.n_tokens for r in got}) == 1 and all(r.complete for r in got)


def test_repeated_ids_and_clashing_columns(make, library):
    docs = make([(1, "a b", 0, "x"), (1, "a b", 0, "y"), (None, None, 1, "z"), (2, "long " * 200_000, 2, "")], "doc_id long, text string, file int, ids string")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in separators.document_counts(docs).collect())
    n = [len(library.encode(t, add_special_tokens=False).ids) + 1 for t in ("a b", "long " * 200_000)]
    assert got == [(0, 1), (1, n[0]), (1, n[0]), (2, n[1])]
