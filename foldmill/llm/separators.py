"""Token counts of flat token files: vectorised search for end-of-document ids, stitched by a prefix scan.

A flat token file is a run of little-endian ids without any index. Tasks open byte ranges of it by seek, so a file may have any length and is read by
many tasks: rows (file, block, ids binary). A document is what stands before an end-of-document id, which it includes; ids after a
file's last end id are a document that is not complete.

Each block is searched by itself in one vector operation. What its first document has before the block comes from an exclusive
prefix scan over (ids, separators, place of the last separator) of the file's blocks, in two levels, so that one task never scans
more than ``SPAN`` blocks or the sums of the spans of a file.

Blocks without ids are allowed; a file without ids has no documents; null ``ids`` count as none; a file that ends within an id is an error. An empty table gives
no rows. A document may be longer than any block. Repeated rows (also of one doc_id) are documents of their own; there are no ties, as places in a file are unique. Extra columns are not read.

Files are opened in the tasks through Arrow's file systems (local paths, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmill.llm import tokens
from foldmill.llm.common import discard, partitions, ready, slices, stored
from foldmill.session import new_folder

#: Blocks that one window of the first level scans.
SPAN = 1024
#: Bytes that one read of a file takes; a multiple of any id's width.
BLOCK_BYTES = 1 << 21
WRITTEN = "file int, path string, length long, first_doc long, doc_ids array<long>"


def _place(path: str):
    """Arrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    local = path.removeprefix("file:")
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the flat files at ``path`` (columns file, block, ids); a file's name is its id. Files are listed, not read, here."""
    listed = spark.read.format("binaryFile").load(path)
    return read_ranges(listed.select(F.col("path").alias("file"), "path", "length"), block_bytes)


def _ranges(files: DataFrame, block_bytes: int) -> DataFrame:
    """Byte ranges (file, block, path, at, size) of the files in rows (file, path, length), dealt to all tasks, whichever file they are of; an empty file has one empty range."""
    if block_bytes % 8:
        raise ValueError("a block must hold whole ids: take a multiple of 8 bytes")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))
    ranges = files.select("file", "path", "length", F.posexplode(starts).alias("block", "at"))
    ranges = ranges.select("file", F.col("block").cast("long").alias("block"), "path", "at", F.least(F.col("length") - F.col("at"), F.lit(block_bytes)).alias("size"))
    return ranges.repartition(partitions(ready(files.sparkSession)), "file", "block")


def _opened(batch):
    """The bytes of each range of a batch, one after another."""
    for path, at, size in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
        system, name = _place(path)
        held = b""
        if size:
            with system.open_input_file(name) as file:
                held = file.read_at(size, at)
        if len(held) != size:
            raise OSError(f"{path} is shorter than it was listed")
        yield held


def read_ranges(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (file, block, ids) of the files in rows (file, path, length)."""
    ranges = _ranges(files, block_bytes)

    def run(batches):
        for batch in batches:
            for i, held in enumerate(_opened(batch)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([held], pa.binary())], names=["file", "block", "ids"])

    return ranges.mapInArrow(run, f"file {files.schema['file'].dataType.simpleString()}, block long, ids binary")


def write_flat_files(docs: DataFrame, folder: str, path: str | None = None) -> tuple[DataFrame, int]:
    """Write documents as flat token files in ``folder``, one for each task that reads them; what was written, and the end-of-document id.

    The end id is the first one the tokenizer cannot give, so texts never hold it. The rows name each file (file, path, length) and, apart (``doc_ids`` set), the
    documents' ids in their order; they hold no lengths. Null text: the end id only. Each attempt of a task writes a file of its own name, so only
    the files that the rows name are whole; others, of lost attempts, are not read. The folder must be new: the rows are written once, at this call.
    """
    path = path or tokens.default_path()
    end_id = tokens.encoder(path).vocabulary
    wide = "<u2" if end_id < 65536 else "<u4"

    def row(file, name=None, length=None, first=None, names=None):
        columns = [pa.array([file], pa.int32()), pa.array([name], pa.string()), pa.array([length], pa.int64()), pa.array([first], pa.int64()), pa.array([names], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["file", "path", "length", "first_doc", "doc_ids"])

    def run(batches):
        from pyspark import TaskContext

        coder, file = tokens.encoder(path), TaskContext.get().partitionId()
        target = f"{folder}/{file:06d}-{uuid.uuid4().hex}.ids"
        system, name = _place(target)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        seen = length = 0
        with system.open_output_stream(name) as out:
            for batch in batches:
                names, texts = batch.column(0).to_pylist(), ["" if x is None else x for x in batch.column(1).to_pylist()]
                for a, b in slices([len(x) for x in texts], 2_000_000):
                    found, n = coder.encode(texts[a:b])
                    ends = np.cumsum(n + 1)
                    flat = np.full(int(ends[-1]), end_id, wide)
                    inner = np.ones(len(flat), bool)
                    inner[ends - 1] = False
                    flat[inner] = found
                    out.write(pa.py_buffer(flat))
                    length += flat.nbytes
                yield row(file, first=seen, names=names)
                seen += len(names)
        yield row(file, target, length)

    ready(docs.sparkSession)
    return stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, WRITTEN), "flat-files"), end_id


def _searched(batch, ids: list[np.ndarray], end_id: int):
    places = [np.flatnonzero(x == end_id).astype(np.int64) for x in ids]
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in places]), pa.int32()), pa.array(np.concatenate(places)))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()), lists], names=["file", "block", "n", "places"])


def separators(blocks: DataFrame, end_id: int, wide: str = "<u2") -> DataFrame:
    """For each block: its number of ids and the places of its end ids."""
    kind = np.dtype(wide)

    def run(batches):
        for batch in batches:
            yield _searched(batch, [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in batch.column(2)], end_id)

    ready(blocks.sparkSession)
    return blocks.select("file", "block", "ids").mapInArrow(run, f"file {blocks.schema['file'].dataType.simpleString()}, block long, n long, places array<long>")


def file_separators(files: DataFrame, end_id: int, wide: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What :func:`separators` gives for the blocks of files (file, path, length); ranges are read and searched by the same worker, their ids go nowhere else."""
    kind = np.dtype(wide)

    def run(batches):
        for batch in batches:
            for i, held in enumerate(_opened(batch)):
                yield _searched(batch.slice(i, 1), [np.frombuffer(held, kind)], end_id)

    return _ranges(files, block_bytes).mapInArrow(run, f"file {files.schema['file'].dataType.simpleString()}, block long, n long, places array<long>")


def scanned(found: DataFrame, span: int = SPAN) -> DataFrame:
    """Add to each block what stands before it in its file: ``at`` ids, ``docs`` separators, and ``last``, the end of the
    last complete document (0 if none)."""
    found = found.withColumn("span", F.floor(F.col("block") / span)).withColumn("ends", F.size("places").cast("long"))
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumn("at_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.withColumn("end_in", F.when(F.col("ends") > 0, F.col("at_in") + F.element_at("places", -1) + 1))
    rows = rows.withColumn("docs_in", F.coalesce(F.sum("ends").over(inside), F.lit(0))).withColumn("last_in", F.max("end_in").over(inside))
    sums = rows.groupBy("file", "span").agg(F.sum("n").alias("n_all"), F.sum("ends").alias("docs_all"), F.max("end_in").alias("end_all"))
    before = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("at_0", F.coalesce(F.sum("n_all").over(before), F.lit(0))).withColumn("docs_0", F.coalesce(F.sum("docs_all").over(before), F.lit(0)))
    sums = sums.withColumn("last_0", F.coalesce(F.max(F.col("at_0") + F.col("end_all")).over(before), F.lit(0)))
    rows = rows.join(sums.select("file", "span", "at_0", "docs_0", "last_0"), ["file", "span"])
    return rows.select("file", "block", "n", "places", (F.col("at_0") + F.col("at_in")).alias("at"), (F.col("docs_0") + F.col("docs_in")).alias("docs"), F.coalesce(F.col("at_0") + F.col("last_in"), F.col("last_0")).alias("last"))


def token_counts(blocks: DataFrame, end_id: int, wide: str = "<u2", span: int = SPAN) -> DataFrame:
    """Per document of the flat files in ``blocks``: file, ordinal (from 0 in its file), start (in ids), n_tokens, complete."""
    return counted(separators(blocks, end_id, wide), span)


def file_counts(files: DataFrame, end_id: int, wide: str = "<u2", span: int = SPAN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """:func:`token_counts` of files (file, path, length) by byte ranges."""
    return counted(file_separators(files, end_id, wide, block_bytes), span)


def counted(found: DataFrame, span: int = SPAN) -> DataFrame:
    """Documents from the blocks' separators."""
    found = stored(found, "separators")
    rows = stored(scanned(found, span), "scanned")
    discard(found)
    ends = F.transform("places", lambda p: p + F.col("at") + 1)
    whole = rows.where(F.size("places") > 0).select("file", "docs", "last", F.posexplode(F.arrays_zip(ends.alias("end"), F.concat(F.array("last"), F.slice(ends, 1, F.size("places") - 1)).alias("start"))))
    whole = whole.select("file", (F.col("docs") + F.col("pos")).alias("ordinal"), F.col("col.start").alias("start"), (F.col("col.end") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("complete"))
    tails = rows.groupBy("file").agg(F.max(F.col("at") + F.col("n")).alias("end"), F.max(F.col("docs") + F.size("places")).alias("ordinal"), F.max(F.greatest(F.col("last"), F.when(F.size("places") > 0, F.col("at") + F.element_at("places", -1) + 1).otherwise(0))).alias("start"))
    tails = tails.where("end > start").select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete"))
    return whole.unionByName(tails)


def document_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` as flat token files in the shared folder, count by separators, and name the documents again."""
    written, end_id = write_flat_files(docs, new_folder(docs.sparkSession, "tokens"), path)
    files = written.where("path is not null").select("file", "path", "length")
    counts = file_counts(files, end_id, "<u2" if end_id < 65536 else "<u4")
    names = written.where("doc_ids is not null").select("file", "first_doc", F.posexplode("doc_ids").alias("pos", "doc_id"))
    names = names.select("file", (F.col("first_doc") + F.col("pos")).alias("ordinal"), "doc_id")
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens", "complete")
