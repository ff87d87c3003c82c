"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. A benchmark item has windows of ``window`` words (or
one window, all its words, if it has fewer). Of each text the smallest hash of every ``window - k + 1`` neighbouring
k-grams is kept, so two texts that share a window share a kept hash. Documents' hashes are joined with the benchmark's; a hit is extended to
the windows that hold the k-gram, and these are joined, as words, with the benchmark's windows. Hashes only select: what counts as
a hit is decided on the words, so there are no false ones.

Before the join a document's hashes pass a bitmap of the benchmark's, whose size (8 MB) does not depend on any table; it drops only
hashes that the join would drop.

Null or empty texts have no words. An item without words has no windows. An item with a null item_id marks words but is not listed. Repeated documents
and items are kept; an empty benchmark leaves every document clean. Extra columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.llm.common import ready, stored

WINDOW = 10
KGRAM = 5
BITMAP_BITS = 26
#: Bytes that belong to words keep their value (A-Z become a-z); all others become blanks.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SEED_SCHEMA = "rid long, doc_id long, digest long, n_words long, seeds array<struct<hash:long,at:long,len:int,words:array<string>>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for i in range(k):
        found = found * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    found ^= found >> np.uint64(29)
    return found * np.uint64(0xBF58476D1CE4E5B9)


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """Places whose hash is the smallest of some ``span`` neighbours (ties: all of them)."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    for i in range(1, span):
        np.minimum(least, grams[i : i + n], out=least)
    kept = np.zeros(len(grams), bool)
    for i in range(span):
        kept[i : i + n] |= grams[i : i + n] == least
    return np.flatnonzero(kept)


def _seeds(hashes: np.ndarray, length: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes kept for windows of ``length`` words; shorter windows than k use all of their words."""
    size = min(k, length)
    grams = gram_hashes(hashes, size)
    at = winnow(grams, length - size + 1)
    return at, grams[at] ^ np.uint64(0 if length == window else length)


def item_windows(benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """Rows item_id, len, words (a window's text), hashes (kept hashes of its k-grams)."""

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not words:
                    continue
                length = min(window, len(words))
                hashes = word_hashes(words)
                at, seeds = _seeds(hashes, length, window, k)
                size = min(k, length)
                for i in range(len(words) - length + 1):
                    inside = (at >= i) & (at <= i + length - size)
                    rows.append({"item_id": item, "len": length, "words": b" ".join(words[i : i + length]).decode(), "hashes": seeds[inside].view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("item_id", batch.schema.field(0).type), ("len", pa.int32()), ("words", pa.string()), ("hashes", pa.list_(pa.int64()))]))

    ready(benchmark.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", F.col("text").cast("string")).mapInArrow(run, f"item_id {kind}, len int, words string, hashes array<long>")


def bitmap(windows: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """One bit for each low part of a kept hash. The words of the bitmap that have bits are grouped on the executors; their number is
    bounded by the bitmap's size."""
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    rows = windows.select(F.explode("hashes").alias("hash")).select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["word"].to_numpy(np.int64)] = found["bit"].to_numpy(np.int64)
    return words.tobytes()


@functools.lru_cache(maxsize=1)
def _bits(shared) -> np.ndarray:
    return np.frombuffer(shared.value, np.uint64)


def document_seeds(docs: DataFrame, lengths: list[int], shared, window: int = WINDOW, k: int = KGRAM, bits: int = BITMAP_BITS) -> DataFrame:
    """Per document its word count and the kept hashes that pass the bitmap, each with the windows around it."""
    low = np.uint64((1 << bits) - 1)

    def run(batches):
        held = _bits(shared)
        for batch in batches:
            counts, ends, hashes_out, at_out, len_out, words_out = [], [0], [], [], [], []
            for text in batch.column(3):
                words = words_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                counts.append(len(words))
                hashes = word_hashes(words)
                for length in lengths:
                    at, seeds = _seeds(hashes, length, window, k)
                    place = seeds & low
                    hit = np.flatnonzero(held[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                    size = min(k, length)
                    for i in hit.tolist():
                        first = max(0, int(at[i]) - length + size)
                        last = min(int(at[i]), len(words) - length)
                        hashes_out.append(int(seeds[i : i + 1].view(np.int64)[0]))
                        at_out.append(first)
                        len_out.append(length)
                        words_out.append([b" ".join(words[j : j + length]).decode() for j in range(first, last + 1)])
                ends.append(len(hashes_out))
            seeds = pa.StructArray.from_arrays([pa.array(hashes_out, pa.int64()), pa.array(at_out, pa.int64()), pa.array(len_out, pa.int32()), pa.array(words_out, pa.list_(pa.string()))], names=["hash", "at", "len", "words"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), seeds)], names=["rid", "doc_id", "digest", "n_words", "seeds"])

    ready(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SEED_SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """Per document: rid, doc_id, digest (XXH64 of the text), n_words, n_hit, items (array of item ids with windows in it), spans (array of start, end in words).

    ``rid`` tells rows of one doc_id apart; it is fixed once the first step is written.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, window, k), "windows")
    lengths = sorted(row["len"] for row in windows.select("len").distinct().collect())  # at most ``window`` values
    shared = spark.sparkContext.broadcast(bitmap(windows))
    seeds = stored(document_seeds(docs, lengths, shared, window, k), "seeds")
    kept = windows.select(F.explode("hashes").alias("hash")).distinct()
    seen = seeds.select("rid", F.explode("seeds").alias("s")).select("rid", F.col("s.hash").alias("hash"), "s.at", "s.len", "s.words")
    around = seen.join(kept, "hash", "left_semi").select("rid", "len", F.col("at"), F.posexplode("words").alias("i", "text")).select("rid", "len", (F.col("at") + F.col("i")).alias("at"), "text").distinct()
    items = windows.select("len", F.col("words").alias("text"), "item_id").distinct()
    hits = stored(around.join(items.select("len", "text").distinct(), ["len", "text"], "left_semi"), "hits")
    before = Window.partitionBy("rid").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.withColumn("end", F.col("at") + F.col("len")).withColumn("done", F.coalesce(F.max("end").over(before), F.lit(-1)))
    fresh = ends.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("at", "done"))).withColumn("opens", F.col("at") > F.col("done"))
    fresh = fresh.withColumn("span", F.sum(F.col("opens").cast("long")).over(Window.partitionBy("rid").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, 0)))
    spans = fresh.groupBy("rid", "span").agg(F.min("at").alias("start"), F.max("end").alias("end"), F.sum("new").alias("new"))
    spans = spans.groupBy("rid").agg(F.sum("new").alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    named = hits.select("rid", "len", "text").distinct().join(items, ["len", "text"]).select("rid", "item_id").distinct().groupBy("rid").agg(F.collect_set("item_id").alias("items"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = spans.join(named, "rid", "left")
    rows = seeds.select("rid", "doc_id", "digest", "n_words").join(found, "rid", "left")
    return rows.select("rid", "doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of ``contamination``."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; columns as they were.

    Contaminated rows are few beside the rest, so they are taken out by doc_id and digest rather than by moving all texts.
    """
    found = contamination(docs, benchmark).where("n_hit > 0").select("doc_id", "digest").distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["digest"])
    return docs.join(found, same, "left_anti")
