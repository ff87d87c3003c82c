"""Repeatable folds, splits, shuffles and samples over a table with a unique key."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmill.functions.hashing import hash32, key_hash
from foldmill.operators.rank import cuts_passed, global_rank, rank_cuts


def fold_starts(rows: int, folds: int) -> list[int]:
    """First rank of folds 1..k-1; the first ``rows % folds`` folds hold one row more."""
    size, extra = divmod(rows, folds)
    return [f * size + min(f, extra) for f in range(1, folds)]


def kfold(df: DataFrame, key: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Seeded shuffled k-fold with sizes that differ by at most one.

    The rows themselves are not moved: each is compared with the k-1 border rows. Rows that share a key share a fold, so
    sizes differ by more where keys repeat.
    """
    _, cuts = rank_cuts(df, key, seed, lambda n: fold_starts(n, folds))
    return df.withColumn(name, cuts_passed(cuts, key, seed))


def kfold_by_hash(df: DataFrame, key: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Folds from the key hash alone: one projection, sizes equal up to chance."""
    return df.withColumn(name, hash32(key, seed) % folds)


def train_rows(folded: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return folded.filter(F.col(name) != fold)


def test_rows(folded: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return folded.filter(F.col(name) == fold)


def fold_id_lists(
    folded: DataFrame, key: str, folds: int, pieces: int, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Fold table as sorted id lists: one row per fold, role and piece.

    A single list per fold would put a fifth of all keys in one row. ``pieces`` sets how many lists a fold
    is cut into, by key hash; see :func:`list_pieces`.
    """
    lists = (
        folded.groupBy(F.col(name).alias("_home"), (hash32(key, f"{seed}:piece") % pieces).alias("piece"))
        .agg(F.sort_array(F.collect_list(key)).alias("ids"))
    )
    every_fold = F.array(*[F.lit(f).cast("bigint") for f in range(folds)])
    role = F.when(F.col(name) == F.col("_home"), F.lit("test")).otherwise(F.lit("train"))
    return lists.withColumn(name, F.explode(every_fold)).select(
        name, role.alias("role"), F.col("_home").alias("source_fold"), "piece", "ids"
    )


def list_pieces(rows: int, folds: int, ids_per_list: int = 10_000) -> int:
    """Pieces per fold that keep a list near ``ids_per_list`` ids."""
    return max(1, -(-rows // (folds * ids_per_list)))


def rows_by_id_list(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed. ``ids`` may repeat keys; they are made distinct before the shuffle, so that an often
    repeated one does not fill a partition."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def join_folds(df: DataFrame, fold_table: DataFrame, key: str) -> DataFrame:
    """Bring a stored ``(key, fold)`` table back to the samples."""
    return df.join(fold_table.select(key, "fold"), key)


def train_val_test(df: DataFrame, key: str, seed: int = 42, name: str = "part") -> DataFrame:
    """70/15/15: the held-out 30 % is rounded up, and so is the test half of it."""

    def borders(rows: int) -> list[int]:
        held_out = -(-3 * rows // 10)
        test = -(-held_out // 2)
        return [rows - held_out, rows - test]

    _, cuts = rank_cuts(df, key, seed, borders)
    # With a single row both borders are rank 0 and everything is test, as the rounding says.
    labels = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    return df.withColumn(name, F.element_at(labels, (cuts_passed(cuts, key, seed) + 1).cast("int")))


def holdout_tail(
    df: DataFrame, key: str, share: float = 0.2, seed: int = 42, name: str = "is_holdout"
) -> DataFrame:
    """Mark the last ``share`` of the seeded order for validation during a final fit."""
    keep = 1 - Fraction(str(share))
    _, cuts = rank_cuts(df, key, seed, lambda n: [int(n * keep)])
    return df.withColumn(name, cuts_passed(cuts, key, seed) > 0)


def stable_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in the seeded order: a range-partitioned sort."""
    return df.orderBy(key_hash(key, seed), key)


def shuffled_positions(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows with their position in the seeded order."""
    return global_rank(df, key, seed, "position")


#: Samples up to this size are taken by one scan that keeps the first rows of each task.
SMALL_SAMPLE = 10_000


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the first in the seeded order; rows of one key are taken or left together.

    A small sample reads the table once: one row more than asked for tells whether the last key goes on behind the sample. A large one is cut at its border row.
    """
    if n > SMALL_SAMPLE:
        _, cuts = rank_cuts(df, key, seed, lambda _: [n])
        return df.filter(cuts_passed(cuts, key, seed) == 0)
    every = Window.partitionBy(F.lit(0))  # n + 1 rows
    first = df.withColumn("_place", F.struct(key_hash(key, seed).alias("h"), F.col(key).alias("k"))).orderBy("_place").limit(n + 1)
    first = first.withColumn("_rows", F.count("*").over(every)).withColumn("_last", F.max("_place").over(every))
    return first.filter((F.col("_rows") <= n) | ~F.col("_place").eqNullSafe(F.col("_last"))).select(*df.columns)
