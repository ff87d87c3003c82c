"""What the operators share: tables in the shared folder, and the number of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldmill import session


def stored(df: DataFrame, name: str, compression: str = "zstd", by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, and every later scan sees the same rows."""
    path = session.new_folder(df.sparkSession, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that no later step reads."""
    session.remove_folder(df.sparkSession, df.stored_at)


def partitions(spark: SparkSession) -> int:
    """The session's own number of shuffle partitions, which the cluster sets to its size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ready(spark: SparkSession) -> SparkSession:
    """Executors can import this package after this call."""
    session.ship_package(spark)
    return spark


def slices(lengths, most: int):
    """Consecutive ranges ``(a, b)`` over items of these lengths, of about ``most`` in total; a longer item stands alone."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)
