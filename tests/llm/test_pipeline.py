"""The pipeline's stages against plain versions on a small table, and their columns."""

from __future__ import annotations

import re
import zlib

import numpy as np
import xxhash

import corpus_pipeline
from foldmill.llm import quality
from foldmill.llm.common import stored
from foldmill.llm.tokens import default_path

SHOWN = re.compile(rb"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in text)


def plain_fingerprint(text: str | None) -> int:
    words = SHOWN.findall(lowered((text or "").encode()))
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(texts: dict[int, str]) -> set[int]:
    """The smallest id of each group that fingerprints of at most four differing bits link."""
    ids = sorted(texts)
    prints = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(prints[a + 1 :] ^ prints[a]) <= 4) + a + 1:
            x, y = find(a), find(int(b))
            root[max(x, y)] = min(x, y)
    return {ids[a] for a in range(len(ids)) if find(a) == a}


def plain_clean(texts: dict[int, str], items: list[str]) -> set[int]:
    """Documents without any run of ten words of an item (all its words, if it has fewer)."""
    words = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {tuple(w[i : i + 10]) for w in map(words, items) if w for i in range(max(1, len(w) - 9))}
    lengths = sorted({len(w) for w in windows})

    def seen(w):
        return any(tuple(w[i : i + n]) in windows for n in lengths for i in range(len(w) - n + 1))

    return {i for i, t in texts.items() if not seen(words(t))}


def plain_shares(sizes: dict[str, int]) -> dict[str, float]:
    """Targets of the sources: weights 1, 2, 3 in turn, at most three times their size."""
    names = sorted(sizes)
    weights, left, total = {s: 1 + i % 3 for i, s in enumerate(names)}, set(names), sum(sizes.values())
    target: dict[str, float] = {}
    while left:
        room = total - sum(target.values())
        share = {s: room * weights[s] / sum(weights[t] for t in left) for s in left}
        full = {s for s in left if share[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in full} if full else share
        left -= full or left
    return target


def test_stages_equal_plain_versions(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        texts = {i: r.text for i, r in before.items()}
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        rows = docs.collect()
        ids = [r.doc_id for r in rows]
        after[name] = len(rows)
        if name == "quality classifier":
            given = spark.read.parquet(f"{sf_dir}/documents.parquet")
            model = quality.fitted(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            x = np.array([quality.features((t or "").encode()) for t in texts.values()])
            assert set(ids) == {i for i, s in zip(texts, model.scores(x)) if s >= 0.7}
        elif name == "SimHash near-dedup":
            assert sorted(ids) == sorted(plain_groups(texts))
        elif name == "benchmark decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert set(ids) == plain_clean(texts, items)
        elif name == "mixing sources to target weights":
            size = {i: len(SHOWN.findall((t or "").encode())) for i, t in texts.items()}
            sizes: dict[str, int] = {}
            for i, r in before.items():
                sizes[r.source] = sizes.get(r.source, 0) + size[i]
            got = dict.fromkeys(sizes, 0)
            for r in rows:
                got[r.source] += size[r.doc_id]
                assert r == before[r.doc_id]
            longest = {s: max(size[i] for i, r in before.items() if r.source == s) for s in sizes}
            assert all(abs(got[s] - t) <= longest[s] + 1 for s, t in plain_shares(sizes).items())
            assert max(ids.count(i) for i in set(ids)) <= 3
            mixed = sorted(ids)
        else:
            coder, start = Tokenizer.from_file(default_path()), 0
            found = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])
            assert [r[0] for r in found] == mixed
            for doc_id, at, n, crc in found:
                tokens = np.array([*coder.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
                assert (at, n, crc) == (start, len(tokens), zlib.crc32(tokens.tobytes()))
                start += n
        if name != "token-ID / binary output":
            assert docs.columns == columns
    assert list(after) == [name for name, _ in corpus_pipeline.STAGES] and all(after.values())


def test_empty_table_passes_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.count() == 0


def test_extra_columns_stay(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    docs = docs.withColumns({"size": F.lit(1), "copies": F.lit("c"), "rid": F.lit(2), "score": F.lit(None).cast("double"), "fp": F.lit("f"), "rank": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stored(stage(spark, docs, sf_dir), "test-stage")
        assert after.columns == docs.columns and after.where("size = 1 and copies = 'c' and rid = 2 and fp = 'f'").count() == after.count()
        docs = after
