"""A corpus in five stages: quality, near copies, benchmark passages, mixture, token files.

Each stage takes all rows that the one before kept, and all but the last return the columns of ``documents``. Null texts
count as empty in every stage; an empty table passes through; columns that a stage does not know are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldmill.llm import ans, decontaminate, mixing, quality, simhash
from foldmill.llm.common import discard, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints link: four-word shingles, at most four differing bits."""
    return simhash.one_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their weights."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, read back: doc_id, start, n_tokens, ids_crc32."""
    return ans.token_documents(docs)


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("benchmark decontamination", unseen),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", tokens),
]
#: Tokenizers and trained scores have no SQL form; tests/llm/test_pipeline.py compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), "stage")
        if i:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
