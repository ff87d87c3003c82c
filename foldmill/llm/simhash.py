"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has 8 bytes. Two fingerprints that differ in at most ``distance`` bits share at least ``8 - distance`` bytes at
their positions. The index lists fingerprints under groups of positional bytes chosen so that every
possible set of shared positions holds a whole group; each list is then read once. Inside a list the shared positional
bytes of pairs are tallied, pairs that reach the guaranteed minimum are kept and their bits compared.

Fingerprints are made distinct before they are indexed, so copies cost nothing, and a list gives a spanning forest of its
links rather than its pairs: its output is never longer than the list. Within a list a fingerprint that is linked leaves the
ones still to be compared, so a dense group of near copies takes about one comparison for each member. A list longer than
``most`` is dealt to pairs of its shares, each in its own task.

Null text counts as empty; an empty text has fingerprint zero and is linked like any other. Ties and repeated rows are
kept, an empty table gives no rows, columns other than doc_id and text are not read. A null doc_id keeps its row and gives no name to its group
unless the whole group has none.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import partitions, ready, stored
from foldmill.llm.components import components

WORDS = 4
DISTANCE = 4
#: Bytes in an index key. 3 bytes make 23 keys for a distance of 4; each list then holds one in 16.7 million fingerprints.
KEY_BYTES = 3
#: Longest list that one task compares by itself.
LONGEST_LIST = 20_000


def fingerprint_of(text: bytes, words: int = WORDS) -> int:
    """SimHash of one text: majority of the XXH64 bits of its word shingles, as an unsigned integer."""
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    joined = b" ".join(found)
    k = min(words, len(found))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(found) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Columns doc_id, fp (the fingerprint's bits as a signed long)."""

    def run(batches):
        for batch in batches:
            found = [fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else b"", words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def key_groups(distance: int = DISTANCE, size: int = KEY_BYTES) -> list[tuple[int, ...]]:
    """Groups of ``size`` byte positions such that any ``8 - distance`` positions hold one of them whole.

    A greedy cover: the group that lies in most of the choices still open comes next.
    """
    shared = [frozenset(x) for x in itertools.combinations(range(8), 8 - distance)]
    size = min(size, 8 - distance)
    groups, left = [], set(shared)
    every = [frozenset(x) for x in itertools.combinations(range(8), size)]
    while left:
        best = max(every, key=lambda g: sum(g <= s for s in left))
        groups.append(tuple(sorted(best)))
        left = {s for s in left if not best <= s}
    return groups


def _forest(fps: np.ndarray, share: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of distinct fingerprints of one list, where two items of the same share (if
    shares differ at all) are left to another task."""
    least = 8 - distance
    left = np.arange(len(fps))
    a, b = [], []
    mixed = share.min() != share.max()
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            other = fps[i] ^ fps[left]
            shared = np.zeros(len(left), np.int8)
            for p in range(8):
                shared += ((other >> np.uint64(8 * p)) & np.uint64(255)) == 0
            near = shared >= least
            near[near] = np.bitwise_count(other[near]) <= distance
            if mixed:
                near &= share[left] != share[i]
            hit = left[near]
            if len(hit):
                a.append(np.full(len(hit), i))
                b.append(hit)
                queue.extend(hit.tolist())
                left = left[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links(distinct: DataFrame, distance: int = DISTANCE, size: int = KEY_BYTES, most: int = LONGEST_LIST) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose components are those of all pairs within ``distance``."""
    groups = key_groups(distance, size)
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
    keys = []
    for n, group in enumerate(groups):
        key = F.lit(n).cast("long")
        for p in group:
            key = F.shiftleft(key, 8).bitwiseOR(byte(p))
        keys.append(key)
    posted = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    heavy = posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key", F.ceil(F.col("n") / (most // 2)).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")
    dealt = posted.join(heavy, "key", "left")
    pairs = F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda i: F.least(i, F.col("share")) * F.col("shares") + F.greatest(i, F.col("share")))
    dealt = dealt.withColumn("share", F.coalesce(share, F.lit(0)))
    dealt = dealt.select("fp", "key", "share", F.explode(F.when(F.col("shares").isNull(), F.array(F.lit(-1))).otherwise(pairs)).alias("task"))

    def run(batches):
        held: list[pa.RecordBatch] = []

        def lists(table: pa.Table, final: bool):
            """(fps, shares) of each complete list with two fingerprints at least, and the rest of the table."""
            key, task = table["key"].to_numpy(), table["task"].to_numpy()
            edges = np.flatnonzero((key[1:] != key[:-1]) | (task[1:] != task[:-1])) + 1
            bounds = np.concatenate([[0], edges, [len(key)]] if final else [[0], edges])
            fps, share = table["fp"].to_numpy().view(np.uint64), table["share"].to_numpy()
            several = np.flatnonzero(np.diff(bounds) > 1)
            return [(fps[bounds[i] : bounds[i + 1]], share[bounds[i] : bounds[i + 1]]) for i in several], int(bounds[-1])

        def out(found):
            a, b = [], []
            for fps, share in found:
                i, j = _forest(fps, share, distance)
                a.append(fps[i])
                b.append(fps[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])]).combine_chunks()
            if not len(table):
                continue
            found, done = lists(table, False)
            rest = table.slice(done)
            yield from out(found)
        if rest is not None and len(rest):
            yield from out(lists(rest.combine_chunks(), True)[0])

    ready(distinct.sparkSession)
    ordered = dealt.repartition(partitions(distinct.sparkSession), "key", "task").sortWithinPartitions("key", "task")
    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, size: int = KEY_BYTES, most: int = LONGEST_LIST) -> DataFrame:
    """Each document's fingerprint (16 hex digits) and component_id, the smallest doc_id it reaches by links."""
    found = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, distance, size, most))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (null last, then in the order of reading); columns as they were."""
    held = stored(docs.withColumn("__rid", F.monotonically_increasing_id()), "numbered")
    rows = near_duplicates(held.select(F.col("__rid").alias("doc_id"), "text")).select(F.col("doc_id").alias("__rid"), "component_id")
    named = rows.join(held.select("__rid", F.col("doc_id").cast("long").alias("doc_id")), "__rid")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__rid")
    first = named.groupBy("component_id").agg(F.min_by("__rid", order).alias("__rid")).select("__rid")
    return held.join(first, "__rid", "left_semi").select(*docs.columns)
