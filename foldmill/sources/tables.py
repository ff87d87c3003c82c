"""Reading and writing tables as files or through the catalog.

Tables are parquet unless another format is named; a table format whose jar the session has (``fmt="delta"``) works the same.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, null_value: str = "NA", infer: bool = False
) -> DataFrame:
    """CSV with a header. With a declared schema the header must name its columns in its order: applied by position
    to another order, the schema would swap columns without a word. Inferring types costs a pass of its own."""
    reader = spark.read.option("header", True).option("nullValue", null_value)
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


#: What an inferred column can be, the narrowest first, with the form that its texts must have. Numbers come before dates, as a year is one.
LATTICE = [
    ("bigint", r"[+-]?[0-9]+"), ("double", r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"), ("boolean", r"(?i)true|false"),
    ("date", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"), ("timestamp", r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9].*"),
]


def infer_csv(spark: SparkSession, path: str, sentinels: tuple[str, ...] = ("", "NA", ".")) -> DataFrame:
    """CSV with a header, types inferred from all rows: one pass counts for each column the texts that are no bigint, double, boolean, date or timestamp.

    Texts that stand for missing values are null first, so a column of numbers with a few of them is numeric. A column without values is text, and so is one that fits nothing else;
    text columns keep all their other texts as they are, blanks around them included.
    """
    texts = spark.read.option("header", True).csv(path)

    def known(c: str) -> Column:
        return F.when(~F.trim(F.col(f"`{c}`")).isin(*sentinels), F.col(f"`{c}`"))

    def fits(c: str, kind: str, form: str) -> Column:
        text = F.trim(known(c))
        return F.when(text.rlike(f"^({form})$"), text.try_cast(kind))

    counts = [F.count(known(c)).alias(f"{i}") for i, c in enumerate(texts.columns)]
    counts += [F.count_if(known(c).isNotNull() & fits(c, *kind).isNull()).alias(f"{i}_{kind[0]}") for i, c in enumerate(texts.columns) for kind in LATTICE]
    found = texts.agg(*counts).first()
    columns = []
    for i, c in enumerate(texts.columns):
        kind = next((kind for kind in LATTICE if found[f"{i}"] and not found[f"{i}_{kind[0]}"]), None)
        columns.append((fits(c, *kind) if kind else known(c)).alias(c))
    return texts.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("nullValue", "NA").csv(path)


def read_path(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_name(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_path(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Overwrite a table that is not among the inputs of ``df``; see :func:`write_version` otherwise."""
    df.write.mode("overwrite").format(fmt).partitionBy(*(partition_by or [])).save(path)


def write_version(df: DataFrame, root: str) -> str:
    """Write the next state of a table beside its earlier ones and return the new path.

    The input may be the table's own latest version, which is left untouched.
    """
    path = os.path.join(root, f"version-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return path


def write_name(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Replace a catalog table; ``df`` must not read it. With ``path`` the files lie there, not in the warehouse."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def replace_name(df: DataFrame, name: str, root: str) -> DataFrame:
    """Replace a catalog table's rows by writing its next version below ``root`` and pointing the table at it in one step.

    Readers see the old rows or the new ones, and plans made before finish on the old files, so ``df`` may read the table itself. A table of other columns is declared anew.
    """
    spark, path = df.sparkSession, write_version(df, root)
    known = spark.catalog.tableExists(name)
    fields = lambda schema: [(f.name, f.dataType) for f in schema]
    if known and fields(spark.table(name).schema) == fields(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        if known:
            spark.sql(f"DROP TABLE {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def empty_name(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Delete all rows of a catalog table by pointing it at an empty version, with what :func:`replace_name` says of readers."""
    return replace_name(spark.table(name).limit(0), name, root)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append a batch. A batch may bring columns that earlier ones lack; see :func:`read_merged`."""
    df.write.mode("append").format(fmt).option("mergeSchema", True).save(path)


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All batches under the union of their columns."""
    return spark.read.format(fmt).option("mergeSchema", True).load(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """The table as JSON lines, written by the executors; nulls are kept as such."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_folds(transformed: DataFrame, path: str) -> None:
    """Transformed folds, one directory per fold and role, so that reading one fold touches only its files."""
    write_path(transformed, path, ["fold", "role"])


def read_fold(spark: SparkSession, path: str, fold: int, role: str) -> DataFrame:
    return read_path(spark, path).filter((F.col("fold") == fold) & (F.col("role") == role))
