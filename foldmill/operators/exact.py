"""Moments whose bits do not depend on the order of the rows.

Sums of doubles round after each step, so they differ with the partitioning. Here every finite value is taken apart into a whole number and a power of
two, and only whole numbers are added: per group, column and exponent three limbs of ``BITS`` bits of the values and six of their squares, all long, so the
executors add them in generated code and before the shuffle. A group and column have at most some 2,100 exponents. Their sums are put together as
Python integers, one small group at a time, and divided once: mean and sum of squared deviations are the correctly rounded values of the exact ones.

A cell holds up to 2^41 rows; with more the sums would pass 63 bits, which is an error in ANSI mode. Null and NaN are no values. An infinite value makes
the mean infinite (null with both signs) and the deviations null. Repeated rows count as often as they occur; an empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 19
MASK = (1 << BITS) - 1
#: A value is its whole number times 2^(exponent - 53); these exponents stand for what has none.
PLUS, MINUS, MISSING = 2000, 2001, 2002
SUMS, SQUARES = ("s0", "s1", "s2"), ("q0", "q1", "q2", "q3", "q4", "q5")


def cells(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group, column and exponent: the number of rows and the sums of limbs. Cells of several tables may be added up."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols]
    long = df.select(*by, F.inline(F.array(*pairs)))
    x, size = F.col("x"), F.abs("x")
    power = F.floor(F.log2(size)).cast("int")
    endless = F.when(x > 0, F.lit(PLUS)).otherwise(F.lit(MINUS))
    exponent = F.when(x.isNull() | F.isnan(x), F.lit(MISSING)).when(size == float("inf"), endless).when(size == 0, F.lit(0)).otherwise(power)
    long = long.withColumn("exponent", exponent).withColumn("half", F.expr("(53 - exponent) div 2"))
    # two steps, since the whole power may be beyond a double; both are exact
    two = lambda k: F.pow(F.lit(2.0), k)
    whole = F.when(F.col("exponent") < PLUS, size * two(F.col("half")) * two(F.lit(53) - F.col("exponent") - F.col("half"))).otherwise(0.0)
    long = long.withColumn("whole", whole.cast("long")).withColumn("sign", F.when(x < 0, -1).otherwise(1).cast("long"))
    low, mid, high = (F.shiftright("whole", BITS * i) for i in range(3))
    long = long.select(*by, "column_name", "exponent", "sign", low.bitwiseAND(MASK).alias("a"), mid.bitwiseAND(MASK).alias("b"), high.alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    products = [a * a, 2 * a * b, b * b + 2 * a * c, 2 * b * c, c * c]
    zero = F.lit(0).cast("long")
    limbs = [(p.bitwiseAND(MASK) if p is not None else zero) + (F.shiftright(q, BITS) if q is not None else zero) for p, q in zip([*products, None], [None, *products])]
    sums = [F.sum(F.col("sign") * part).alias(name) for name, part in zip(SUMS, (a, b, c))]
    return long.groupBy(*by, "column_name", "exponent").agg(F.count("*").alias("n"), *sums, *(F.sum(q).alias(name) for name, q in zip(SQUARES, limbs)))


def added(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by, "column_name", "exponent").agg(*(F.sum(c).alias(c) for c in ("n", *SUMS, *SQUARES)))


def train_cells(per_fold: DataFrame, folds: int) -> DataFrame:
    """The cells of the train rows of every fold: all folds but one."""
    fold_list = F.array(*[F.lit(f).cast("bigint") for f in range(folds)])
    others = per_fold.withColumn("test_fold", F.explode(fold_list)).filter("fold <> test_fold").drop("fold")
    return added(others.withColumnRenamed("test_fold", "fold"), ["fold"])


def moments(sums: DataFrame, by: Sequence[str] = (), unit: int = 60) -> DataFrame:
    """``n_rows, n, mu, m2`` as in ``stats.moments``, and ``units``: the exact sum in units of ``2^-unit`` as a decimal number, null if that is not whole."""
    fields = [sums.schema[c] for c in by] + [T.StructField("column_name", T.StringType())]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("n_rows", "n")), T.StructField("mu", T.DoubleType()), T.StructField("m2", T.DoubleType()), T.StructField("units", T.StringType())])

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *_merged(rows, unit))], columns=schema.names)

    return sums.groupBy(*by, "column_name").applyInPandas(fold, schema)


def _merged(rows: pd.DataFrame, unit: int) -> tuple:
    n_rows = n = total = squares = 0
    endless: set[int] = set()
    known = [r for r in rows.to_dict("records") if r["exponent"] != MISSING]
    least = min((int(r["exponent"]) for r in known if r["exponent"] < PLUS), default=0)
    for r in rows.to_dict("records"):
        n_rows += int(r["n"])
    for r in known:
        n += int(r["n"])
        if r["exponent"] >= PLUS:
            endless.add(int(r["exponent"]))
            continue
        shift = int(r["exponent"]) - least
        total += sum(int(r[c]) << (BITS * i) for i, c in enumerate(SUMS)) << shift
        squares += sum(int(r[c]) << (BITS * i) for i, c in enumerate(SQUARES)) << (2 * shift)
    if not n:
        return n_rows, 0, None, None, None
    if endless:
        mean = None if len(endless) == 2 else float("inf") if PLUS in endless else float("-inf")
        return n_rows, n, mean, None, None
    scale = least - 53  # the sums are total * 2^scale and squares * 2^(2 scale)
    spread = n * squares - total * total
    move = scale + unit
    units = total << move if move >= 0 else (total >> -move if total % (1 << -move) == 0 else None)
    return n_rows, n, _quotient(total, n, scale), _quotient(spread, n, 2 * scale), None if units is None else str(units)


def _quotient(top: int, bottom: int, scale: int) -> float:
    """``top * 2^scale / bottom``, rounded once (division of whole numbers is); infinite beyond the doubles."""
    try:
        return (top << scale) / bottom if scale >= 0 else top / (bottom << -scale)
    except OverflowError:
        return float("inf") if top > 0 else float("-inf")
