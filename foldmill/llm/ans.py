"""Token ids as files of independently decodable blocks: static range asymmetric numeral system (rANS).

Layout. A token file is a parquet table with one row per block, in folders ``part=N``; parts and the
blocks within a part are in ascending order of ``doc_id`` (null first), rows that share a doc_id in the
order of their text's hash and text. A block holds whole documents, at least one and otherwise
``BLOCK_TOKENS`` ids at most, so each block is decoded by itself.

Coding. One frequency table, counted over all ids of the corpus and rounded to a power of two, is shared by all
blocks. A block's ids are dealt to lanes in turn (id i to lane i mod lanes); the lanes' 64-bit states advance
together and put their 32-bit words in one interleaved stream. Every ``CHECKPOINT_STEPS`` steps the states and the
position in the stream are noted, so a block can also be decoded from any of its checkpoints. Each block has a crc32 of its ids.

Null text: an empty document, which has the end id only. Empty table: no blocks. Repeated rows are written as often as
they occur. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmill import session
from foldmill.llm import tokens
from foldmill.llm.common import discard, partitions, ready, slices, stored

LANES = 2048
CHECKPOINT_STEPS = 64
BLOCK_TOKENS = 1 << 18
#: States stay in [LOW, LOW << 32).
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)

RAW_SCHEMA = "part int, block long, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, ids binary, counts array<struct<id:int,n:long>>"
FILE_SCHEMA = "part int, block long, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, lanes int, states binary, checkpoints binary, words binary, crc32 long"
TABLE_SCHEMA = "bits int, frequencies binary"


@dataclass(frozen=True)
class Table:
    """``frequencies[id]`` out of ``1 << bits``; an id that never occurs has 0."""

    bits: int
    frequencies: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Table:
        """Round counts to frequencies: at least 1 for each id that occurs, with an exact sum."""
        counts = np.asarray(counts, np.int64)
        present = int((counts > 0).sum())
        bits = max(16, int(max(present, 1) * 4 - 1).bit_length())
        size, total = 1 << bits, int(counts.sum())
        if not total:
            return cls(bits, np.zeros(len(counts), np.uint32))
        frequencies = np.where(counts > 0, np.maximum(1, np.floor(counts * (size / total))), 0).astype(np.int64)
        order = np.argsort(-frequencies, kind="stable")
        over = int(frequencies.sum()) - size
        for i in order if over > 0 else ():
            taken = min(over, int(frequencies[i]) // 2)
            frequencies[i] -= taken
            over -= taken
            if not over:
                break
        if over < 0:
            frequencies[order[0]] -= over
        return cls(bits, frequencies.astype(np.uint32))

    def starts(self) -> np.ndarray:
        f = self.frequencies.astype(np.uint64)
        return np.cumsum(f) - f

    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies)


class Coder:
    """Encodes and decodes blocks with one table."""

    def __init__(self, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS):
        self.bits, self.lanes, self.every = np.uint64(table.bits), lanes, every
        self.frequency, self.start, self.symbol = table.frequencies.astype(np.uint64), table.starts(), table.symbols()
        self.limit = self.frequency << np.uint64(31 - table.bits + 32)
        self.mask = np.uint64((1 << table.bits) - 1)

    def encode(self, ids: np.ndarray) -> dict:
        lanes = max(1, min(self.lanes, len(ids)))
        steps = -(-len(ids) // lanes)
        state = np.full(lanes, LOW, np.uint64)
        chunks, marks, emitted = [], [], 0
        for step in range(steps - 1, -1, -1):
            now = ids[step * lanes : (step + 1) * lanes]
            x, f = state[: len(now)], self.frequency[now]
            full = x >= self.limit[now]
            out = x[full]
            chunks.append(out.astype(np.uint32))
            emitted += len(out)
            x[full] = out >> WORD
            q = x // f
            state[: len(now)] = (q << self.bits) + (x - q * f) + self.start[now]
            if step and step % self.every == 0:
                marks.append((emitted, state.tobytes()))
        words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
        noted = b"".join((len(words) - n).to_bytes(8, "little") + at for n, at in reversed(marks))
        return {"lanes": lanes, "states": state.tobytes() if len(ids) else b"", "checkpoints": noted, "words": words.tobytes(), "crc32": zlib.crc32(ids.astype("<u4").tobytes())}

    def checkpoints(self, block: dict) -> list[tuple[int, int, np.ndarray]]:
        """(first step, position in the words, states) of every place where decoding can start."""
        size = 8 + 8 * block["lanes"]
        found = [(0, 0, np.frombuffer(block["states"], np.uint64))]
        for i in range(0, len(block["checkpoints"]), size):
            one = block["checkpoints"][i : i + size]
            found.append(((i // size + 1) * self.every, int.from_bytes(one[:8], "little"), np.frombuffer(one[8:], np.uint64)))
        return found

    def decode_from(self, block: dict, first: int, at: int, states: np.ndarray, last: int | None = None) -> np.ndarray:
        """The ids of the steps from ``first`` to before ``last``."""
        n, lanes = block["n_tokens"], block["lanes"]
        steps = -(-n // lanes)
        last = steps if last is None else min(last, steps)
        words = np.frombuffer(block["words"], np.uint32)
        state = states.copy()
        found = np.empty(min(n, last * lanes) - first * lanes, np.uint32)
        for step in range(first, last):
            active = min(lanes, n - step * lanes)
            x = state[:active]
            slot = x & self.mask
            symbol = self.symbol[slot]
            found[(step - first) * lanes : (step - first) * lanes + active] = symbol
            x = self.frequency[symbol] * (x >> self.bits) + slot - self.start[symbol]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << WORD) | words[at : at + len(low)]
            at += len(low)
            state[:active] = x
        return found

    def decode(self, block: dict) -> np.ndarray:
        """All ids of a block, checked against its crc32."""
        if not block["n_tokens"]:
            return np.zeros(0, np.uint32)
        ids = self.decode_from(block, 0, 0, np.frombuffer(block["states"], np.uint64))
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["crc32"]:
            raise ValueError(f"part {block.get('part')}, block {block.get('block')}: checksum differs")
        return ids


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _blocks_of(part: int, batches: Iterator[pa.RecordBatch], path: str, end_id: int, most: int) -> Iterator[dict]:
    """Raw blocks of one partition's documents in their order."""
    coder = tokens.encoder(path)
    block = first = held = 0
    ids: list[np.ndarray] = []
    doc_ids: list = []
    lengths: list[int] = []

    def flush() -> dict:
        nonlocal block, first, held, ids, doc_ids, lengths
        row = {"part": part, "block": block, "first": first, "n_tokens": held, "doc_ids": doc_ids, "doc_tokens": lengths, "ids": np.concatenate(ids).tobytes(), "counts": None}
        block, first, held, ids, doc_ids, lengths = block + 1, first + held, 0, [], [], []
        return row

    for batch in batches:
        texts = ["" if x is None else x for x in batch.column(1).to_pylist()]
        names = batch.column(0).to_pylist()
        for a, b in slices([len(x) for x in texts], 2_000_000):
            found, n = coder.encode(texts[a:b])
            at = 0
            for name, k in zip(names[a:b], n.tolist()):
                if held and held + k + 1 > most:
                    yield flush()
                ids.append(np.append(found[at : at + k], np.uint32(end_id)).astype("<u4" if coder.vocabulary > 65536 else "<u2"))
                doc_ids.append(name)
                lengths.append(k + 1)
                held += k + 1
                at += k
    if held:
        yield flush()


def raw_blocks(docs: DataFrame, path: str, end_id: int, most: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of plain ids in document order, and a row with each task's id counts (``counts`` is set, ``ids`` null)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RAW_SCHEMA))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        counts = np.zeros(0, np.int64)
        for row in _blocks_of(part, batches, path, end_id, most):
            wide = "<u4" if tokens.encoder(path).vocabulary > 65536 else "<u2"
            seen = np.bincount(np.frombuffer(row["ids"], wide))
            if len(seen) > len(counts):
                counts, seen = seen, counts
            counts[: len(seen)] += seen
            yield _arrow([row], schema)
        some = np.flatnonzero(counts)
        if len(some):
            yield _arrow([{"part": part, "counts": [{"id": int(i), "n": int(counts[i])} for i in some]}], schema)

    spark = ready(docs.sparkSession)
    hashed = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange(partitions(spark), F.col("doc_id"), hashed).sortWithinPartitions(F.col("doc_id"), hashed, F.col("text"))
    return ordered.mapInArrow(run, RAW_SCHEMA)


def id_table(raw: DataFrame, size: int) -> Table:
    """The shared table: counts of all ids, summed on the executors; at most ``size`` rows come back."""
    seen = raw.where("counts is not null").select(F.explode("counts").alias("c")).groupBy("c.id").agg(F.sum("c.n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[seen["id"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    return Table.of(counts)


def encode_blocks(raw: DataFrame, table: Table, wide: str) -> DataFrame:
    """Each raw block as a coded block; no shuffle."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(FILE_SCHEMA))

    def run(batches):
        coder = Coder(table)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _arrow([{**row, **coder.encode(np.frombuffer(row.pop("ids"), wide).astype(np.uint32))}], schema)

    plain = raw.where("ids is not null").select("part", "block", "first", "n_tokens", "doc_ids", "doc_tokens", "ids")
    return plain.mapInArrow(run, FILE_SCHEMA)


def write_token_files(docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None) -> str:
    """Encode all ``docs`` and write ``folder/blocks`` and ``folder/table``; returns the folder."""
    spark, path = docs.sparkSession, path or tokens.default_path()
    size = tokens.encoder(path).vocabulary
    raw = stored(raw_blocks(docs, path, end_id), "raw-tokens")
    table = id_table(raw, max(size, end_id + 1))
    encode_blocks(raw, table, "<u4" if size > 65536 else "<u2").write.partitionBy("part").option("compression", "none").parquet(f"{folder}/blocks")
    discard(raw)
    spark.createDataFrame([(table.bits, bytearray(table.frequencies.astype("<u4").tobytes()))], TABLE_SCHEMA).coalesce(1).write.parquet(f"{folder}/table")
    return folder


def read_blocks(spark: SparkSession, folder: str) -> tuple[DataFrame, Table]:
    row = spark.read.schema(TABLE_SCHEMA).parquet(f"{folder}/table").first()
    return spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/blocks"), Table(row["bits"], np.frombuffer(bytes(row["frequencies"]), "<u4"))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents read back: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (array of int)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    blocks, table = read_blocks(ready(spark), folder)
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row for each part
    ends = np.cumsum([0] + [row["n"] for row in totals])
    base = {row["part"]: int(ends[i]) for i, row in enumerate(totals)}
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    schema = to_arrow_schema(_parse_datatype_string(out))

    def run(batches):
        coder = Coder(table)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = coder.decode(row).astype("<u4")
                lengths = np.asarray(row["doc_tokens"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                held = memoryview(ids.tobytes())
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"] + base[row["part"]]), pa.array(lengths)]
                columns.append(pa.array([zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()))
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(starts, ends[-1]).astype(np.int32), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return blocks.mapInArrow(run, out)


def token_documents(docs: DataFrame, end_id: int = 1, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    folder = write_token_files(docs, session.new_folder(docs.sparkSession, "tokens"), end_id, path)
    return read_documents(docs.sparkSession, folder, with_ids)
