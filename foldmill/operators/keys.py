"""A row key for tables that bring none, also when many rows are exact copies of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_PIECE = 10_000


def with_row_key(df: DataFrame, name: str = "row_key", piece: int = COPIES_PER_PIECE) -> DataFrame:
    """Add ``md5(row):copy``. Copies of a row are interchangeable, so it is enough to count them.

    Equal rows are counted first (combined before the shuffle, so a group holding a third of the table
    travels as one row per task), then written out again with copy numbers, in pieces that are spread over a fixed number of
    tasks: sized by what they are before they are written out, they would be put together again.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count("*").alias("_copies"))
    content = F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(piece).cast("bigint"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = counted.withColumn("_from", F.explode(starts)).repartition(tasks, *[F.col(c) for c in cols], F.col("_from"))
    upto = F.least(F.col("_from") + piece, F.col("_copies")) - 1
    numbered = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_from"), upto)))
    return numbered.select(F.concat_ws(":", content, F.col("_copy").cast("string")).alias(name), *cols)
