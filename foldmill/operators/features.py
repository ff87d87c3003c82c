"""Fit on train rows, apply to any rows: impute, scale, encode, assemble.

The fit reads the table twice however many folds there are: once for the moments of the numeric columns and once
for the category counts. What it returns is a pipeline of ML stages that can be saved and loaded.

Categories stay on the executors: a fit numbers them in a stored dictionary (see ``dictionary``), and the driver holds its widths and each column's mode. Names of one-hot slots
are collected only by who asks for them (``FeaturePlan.names``, ``vocabulary``). A plan may also be given short vocabularies of its own.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmill.operators import dictionary, exact, stats
from foldmill.operators.dictionary import MISSING, Dictionary
from foldmill.operators.evaluate import listed
from foldmill.session import remove_folder

log = logging.getLogger(__name__)


def scaled(value: Column, mean: Column, sd: Column) -> Column:
    """Zero mean, unit population deviation; a constant column is only centred."""
    return (value - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)


class ImputeScale(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing numbers with the fitted mean, then standardise."""

    means = Param(Params._dummy(), "means", "mean per input column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation per input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, deviations=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        fitted = zip(
            self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations)
        )
        for source, target, mean, sd in fitted:
            known = F.col(source).cast("double")
            known = F.coalesce(F.when(~F.isnan(known), known), F.lit(mean))
            out[target] = scaled(known, F.lit(mean), F.lit(sd))
        return dataset.withColumns(out)


class FillCategories(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing categories with the fitted most frequent value."""

    fills = Param(Params._dummy(), "fills", "fill per input column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.fills))
        return dataset.withColumns(
            {target: F.coalesce(F.col(source).cast("string"), F.lit(fill)) for source, target, fill in fitted}
        )


class _CoderWriter(DefaultParamsWriter):
    """The dictionary is saved with the stage."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        stage = self.instance
        table = self.sparkSession.read.schema(dictionary.SCHEMA).parquet(stage.getOrDefault(stage.path))
        table.write.parquet(os.path.join(path, "dictionary"))


class _CoderReader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(path=os.path.join(path, "dictionary"))


class DictionaryCoder(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Category codes by a join with a stored dictionary: null takes the fitted mode's code, an unknown value the number of known ones."""

    path = Param(Params._dummy(), "path", "the dictionary", TypeConverters.toString)
    plan = Param(Params._dummy(), "plan", "which of the dictionary's codes", TypeConverters.toInt)
    plans = Param(Params._dummy(), "plans", "codes of each value", TypeConverters.toInt)
    fills = Param(Params._dummy(), "fills", "code of null per input column", TypeConverters.toListInt)
    widths = Param(Params._dummy(), "widths", "codes in use per input column", TypeConverters.toListInt)
    first = Param(Params._dummy(), "first", "the lowest code that has a slot", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, path=None, plan=None, plans=None, fills=None, widths=None, first=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self):
        return _CoderWriter(self)

    @classmethod
    def read(cls):
        return _CoderReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = dataset.sparkSession.read.schema(dictionary.SCHEMA).parquet(self.getOrDefault(self.path))
        sources, targets, first = self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.first)
        coded = dictionary.encode(dataset, table, sources, targets, self.getOrDefault(self.plans))
        out = []
        for target, fill, width in zip(targets, self.getOrDefault(self.fills), self.getOrDefault(self.widths)):
            code = F.col(target)[self.getOrDefault(self.plan)]
            slot = F.when(code == MISSING, fill).otherwise(code) - first
            slots = width - first
            attributes = {"ml_attr": {"type": "nominal", "name": target, "num_vals": slots + 1}}
            out.append(F.when(slot >= 0, slot).otherwise(slots).cast("double").alias(target, metadata=attributes))
        return coded.select(*dataset.columns, *out)


class StoredVocabulary(Mapping):
    """A plan's values by column, collected from its dictionary when somebody looks."""

    def __init__(self, spark, stored: Dictionary, plan: int):
        self._spark, self._stored, self._plan = spark, stored, plan

    def _all(self) -> dict[str, list[str]]:
        return self._stored.values(self._spark, self._plan)

    def __getitem__(self, column: str) -> list[str]:
        return self._all()[column]

    def __iter__(self):
        return iter(self._all())

    def __len__(self) -> int:
        return len(self._all())


@dataclass
class FeaturePlan:
    """Everything a fit has to know: means, deviations and fills by column, and the dictionary with its codes, or short vocabularies."""

    numeric: list[str]
    categorical: list[str]
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    fills: dict[str, str] = field(default_factory=dict)
    vocabulary: Mapping[str, list[str]] = field(default_factory=dict)
    drop_first: bool = False
    stored: Dictionary | None = None
    index: int = 0
    fill_codes: dict[str, int] = field(default_factory=dict)

    def slots(self, column: str) -> list[str]:
        values = self.vocabulary.get(column, [])
        return values[1:] if self.drop_first else values

    def size(self, column: str) -> int:
        """Slots of a category column, without looking at its values."""
        known = self.stored.widths[self.index].get(column, 0) if self.stored else len(self.vocabulary.get(column, []))
        return max(known - self.drop_first, 0)

    @property
    def used_numeric(self) -> list[str]:
        return [c for c in self.numeric if c in self.means]

    @property
    def used_categorical(self) -> list[str]:
        return [c for c in self.categorical if self.size(c)]

    @property
    def width(self) -> int:
        """Slots of the feature vector."""
        return len(self.used_numeric) + sum(map(self.size, self.categorical))

    def names(self) -> list[str]:
        """One name per slot of the feature vector; collects the categories."""
        return self.used_numeric + [f"{c}_{v}" for c in self.used_categorical for v in self.slots(c)]

    def discard(self, spark) -> None:
        """Delete the fit's dictionary; saved models keep a copy."""
        if self.stored:
            remove_folder(spark, self.stored.path)

    def pipeline(self, spark, output: str = "features") -> PipelineModel:
        """The fitted stages. A value outside the vocabulary has no slot, so it encodes as zeros; with
        ``drop_first`` the first category is treated the same way."""
        numbers, texts = self.used_numeric, self.used_categorical
        stages, parts = [], []
        if numbers:
            parts += [f"{c}_scaled" for c in numbers]
            stages.append(
                ImputeScale(
                    inputCols=numbers,
                    outputCols=[f"{c}_scaled" for c in numbers],
                    means=[self.means[c] for c in numbers],
                    deviations=[self.deviations[c] for c in numbers],
                )
            )
        if texts and self.stored:
            index, onehot = [f"{c}_index" for c in texts], [f"{c}_onehot" for c in texts]
            parts += onehot
            coder = DictionaryCoder(
                inputCols=texts, outputCols=index, path=self.stored.path, plan=self.index, plans=len(self.stored.widths), first=int(self.drop_first),
                fills=[self.fill_codes[c] for c in texts], widths=[self.stored.widths[self.index][c] for c in texts],
            )
            # The encoder's sizes come from the columns' metadata: no rows are needed to fit it.
            no_rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in texts))
            stages += [coder, OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True).fit(coder.transform(no_rows))]
        elif texts:
            filled = [f"{c}_filled" for c in texts]
            index, onehot = [f"{c}_index" for c in texts], [f"{c}_onehot" for c in texts]
            parts += onehot
            # "keep" adds one slot for unknown values behind the known ones and dropLast removes just that slot.
            # One indexer per column: label lists of unequal length would be padded.
            indexers = [
                StringIndexerModel.from_labels(self.slots(c), inputCol=f, outputCol=i, handleInvalid="keep")
                for c, f, i in zip(texts, filled, index)
            ]
            # The encoder's sizes come from the indexers' metadata: no rows are needed to fit it.
            no_rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in filled))
            encoder = OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True)
            stages += [
                FillCategories(inputCols=texts, outputCols=filled, fills=[self.fills[c] for c in texts]),
                *indexers,
                encoder.fit(PipelineModel(indexers).transform(no_rows)),
            ]
        stages.append(VectorAssembler(inputCols=parts, outputCol=output))
        return PipelineModel(stages)


#: Feature vectors of at most so many slots are filled in, a few thousand rows at a time; those of longer ones never.
NARROW = 64


class Rows:
    """Feature rows as numbers and, for each category column, the slot that is one (-1: none).

    Layers work on columns, a row of an array for each unit, so that what is done for each class or unit runs along the rows.
    """

    def __init__(self, numbers: np.ndarray, slots: Sequence[np.ndarray] = (), width: int | None = None, room: np.ndarray | None = None):
        """``room`` has a row for each slot and one more, zeros but for the numbers, which lie in its first rows already."""
        self.numbers, self.slots, self.width = numbers, list(slots), width or numbers.shape[1]
        self._room, self._filled = room, None

    def __len__(self) -> int:
        return len(self.numbers)

    def __getitem__(self, rows) -> Rows:
        return Rows(self.numbers[rows], [s[rows] for s in self.slots], self.width)

    def filled(self) -> np.ndarray:
        """The vectors as columns, and a last row of ones for the bias."""
        if self._filled is None:
            count, room = len(self), self._room
            if room is None:
                room = np.zeros((self.width + 1, count))
                room[: self.numbers.shape[1]] = self.numbers.T
            room[-1] = 1.0
            flat, places = room.reshape(-1), np.arange(count)
            for s in self.slots:
                flat[s * count + places] = 1.0  # -1 is the row of ones
            self._filled = room
        return self._filled

    def through(self, w: np.ndarray, b: np.ndarray | float = 0.0) -> np.ndarray:
        """``(rows @ w + b).T``; of wide rows the slots pick rows of ``w``."""
        if self.width <= NARROW:
            return np.vstack([w, np.broadcast_to(b, w.shape[1])]).T @ self.filled()
        out = self.numbers @ w[: self.numbers.shape[1]] + b
        for s in self.slots:
            hit = s >= 0
            out[hit] += w[s[hit]]
        return np.ascontiguousarray(out.T)

    def add_back(self, delta: np.ndarray, total: np.ndarray, bias: np.ndarray | None = None) -> None:
        """Add ``(delta @ rows).T`` to ``total``, and the sums of ``delta`` to ``bias``; ``delta`` has a row for each unit."""
        if self.width <= NARROW:
            found = self.filled() @ delta.T
            total += found[:-1]
            if bias is not None:
                bias += found[-1]
            return
        total[: self.numbers.shape[1]] += self.numbers.T @ delta.T
        for s in self.slots:
            hit = s >= 0
            np.add.at(total, s[hit], delta.T[hit])
        if bias is not None:
            bias += delta.sum(axis=1)

    def times(self, w: np.ndarray) -> np.ndarray:
        """``rows @ w``."""
        return self.through(w).T

    def times_transposed(self, delta: np.ndarray) -> np.ndarray:
        """``rows.T @ delta``."""
        out = np.zeros((self.width, delta.shape[1]))
        self.add_back(delta.T, out)
        return out

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), self.width))
        out[:, : self.numbers.shape[1]] = self.numbers
        for s in self.slots:
            hit = np.flatnonzero(s >= 0)
            out[hit, s[hit]] = 1.0
        return out


@dataclass
class CodeSlots:
    """The slots of dictionary codes from ``base`` on; codes below ``first`` have none, ``MISSING`` takes the code ``fill``."""

    base: int
    first: int
    fill: int

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        place = np.where(codes == MISSING, self.fill, codes) + (self.base - self.first)
        return np.where(place >= self.base, place, -1)


@dataclass
class View:
    """A plan as arrays: turns raw rows into the same vectors as the plan's pipeline.

    Several plans can look at one stored set of raw rows, so folds share it, and one-hot slots are never stored.
    """

    columns: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    codes: list[tuple[int, np.ndarray | CodeSlots]]
    width: int

    def rows(self, raw: np.ndarray | Sequence[np.ndarray]) -> Rows:
        """From an array of raw rows, or a list of the raw columns."""
        columns = raw.T if isinstance(raw, np.ndarray) else raw
        count = len(columns[0]) if len(columns) else 0
        room = np.zeros((self.width + 1, count)) if self.width <= NARROW else None
        known = np.empty((len(self.columns), count)) if room is None else room[: len(self.columns)]
        for out, column, mean, deviation in zip(known, self.columns, self.means, self.deviations):
            np.subtract(columns[column], mean, out=out)
            out /= deviation
            missing = np.isnan(columns[column])
            if missing.any():
                out[missing] = 0.0  # the mean
        return Rows(known.T, [slot_of[columns[column].astype(np.int64)] for column, slot_of in self.codes], self.width, room)

    def vectors(self, raw: np.ndarray) -> np.ndarray:
        return self.rows(raw).dense()


def coded_rows(df: DataFrame, plans: Sequence[FeaturePlan], name: str = "raw") -> tuple[DataFrame, list[View]]:
    """Add an array of numeric values (NaN where missing) and dictionary codes, and the view of each plan on it.

    Plans of one fit share a dictionary, whose join brings the codes of all of them.
    """
    if not all(p.stored for p in plans):
        vocabulary = union_vocabulary(plans)
        return raw_rows(df, plans[0].numeric, plans[0].categorical, vocabulary, name), [view_of(p, vocabulary) for p in plans]
    numeric, categorical, columns = plans[0].numeric, plans[0].categorical, df.columns
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]
    place: dict[tuple[str, int, str], int] = {}
    for number, path in enumerate(dict.fromkeys(p.stored.path for p in plans)):
        mine = [p for p in plans if p.stored.path == path]
        coded = [f"_code{number}_{k}" for k in range(len(categorical))]
        df = dictionary.encode(df, mine[0].stored.table(df.sparkSession), categorical, coded, len(mine[0].stored.widths))
        for index in sorted({p.index for p in mine}):
            for c, code in zip(categorical, coded):
                place[path, index, c] = len(parts)
                parts.append(F.col(code)[index].cast("double"))
    views: dict[int, View] = {}  # networks of one plan share its view, and so the vectors of a pass
    for plan in plans:
        used = plan.used_numeric
        at, codes = len(used), []
        for c in plan.used_categorical:
            codes.append((place[plan.stored.path, plan.index, c], CodeSlots(at, int(plan.drop_first), plan.fill_codes[c])))
            at += plan.size(c)
        views.setdefault(id(plan), View(
            np.array([numeric.index(c) for c in used], dtype=np.int64), np.array([plan.means[c] for c in used]),
            np.array([plan.deviations[c] or 1.0 for c in used]), codes, at,
        ))
    return df.select(*columns, F.array(*parts).alias(name)), [views[id(p)] for p in plans]


def union_vocabulary(plans: Sequence[FeaturePlan]) -> dict[str, list[str]]:
    names = {c for p in plans for c in p.vocabulary}
    return {c: sorted({v for p in plans for v in p.vocabulary.get(c, [])}) for c in names}


def view_of(plan: FeaturePlan, vocabulary: dict[str, list[str]]) -> View:
    """The plan over raw rows that were coded with ``vocabulary``."""
    used = plan.used_numeric
    deviations = [plan.deviations[c] or 1.0 for c in used]
    at, codes = len(used), []
    for c in plan.used_categorical:
        place = {v: at + i for i, v in enumerate(plan.slots(c))}
        # Known codes, then the code of values no plan knows, then that of null, which is -1.
        slot_of = [place.get(v, -1) for v in vocabulary[c]] + [-1, place.get(plan.fills[c], -1)]
        codes.append((len(plan.numeric) + plan.categorical.index(c), np.array(slot_of)))
        at += len(place)
    return View(
        np.array([plan.numeric.index(c) for c in used], dtype=np.int64),
        np.array([plan.means[c] for c in used]), np.array(deviations), codes, at,
    )


def raw_rows(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], vocabulary: dict[str, list[str]], name: str = "raw"
) -> DataFrame:
    """Add an array of the numeric values (NaN where missing) and category codes (-1 where missing)."""
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]
    for c in categorical:
        if not vocabulary.get(c):
            parts.append(F.lit(-1.0))
            continue
        coder = StringIndexerModel.from_labels(vocabulary[c], inputCol=c, outputCol=f"_{c}", handleInvalid="keep")
        df = coder.transform(df)
        parts.append(F.when(F.col(c).isNull(), F.lit(-1.0)).otherwise(F.col(f"_{c}")))
    return df.withColumn(name, F.array(*parts)).drop(*[f"_{c}" for c in categorical])


def _collect_plans(numbers, counts, numeric, categorical, drop_first, folds: int = 1) -> dict[int, FeaturePlan]:
    """Plans from a moments row per fold and column, and one mode and width per fold and column; the categories stay in their dictionary."""
    number_rows = numbers.collect() if numeric else []
    stored, mode_rows = None, []
    if categorical:
        stored = dictionary.build(counts, folds)
        table = stored.table(counts.sparkSession).select("column_name", F.col("value").alias("mode"), "codes")
        modes = stats.most_frequent(counts, ["fold"]).join(table, ["column_name", "mode"])
        mode_rows = modes.select("fold", "column_name", "mode", F.element_at("codes", (F.col("fold") + 1).cast("int")).alias("code")).collect()
    plans: dict[int, FeaturePlan] = {}

    def plan(fold: int) -> FeaturePlan:
        if fold not in plans:
            plans[fold] = FeaturePlan(list(numeric), list(categorical), drop_first=drop_first)
            if stored:
                plans[fold].stored, plans[fold].index = stored, fold
                plans[fold].vocabulary = StoredVocabulary(counts.sparkSession, stored, fold)
        return plans[fold]

    for r in number_rows:
        if r["mu"] is None:
            log.warning("column %s has no value among the train rows; left out", r["column_name"])
            continue
        plan(r["fold"]).means[r["column_name"]] = r["mu"]
        plan(r["fold"]).deviations[r["column_name"]] = r["sd"]
    for r in mode_rows:
        plan(r["fold"]).fills[r["column_name"]] = r["mode"]
        plan(r["fold"]).fill_codes[r["column_name"]] = r["code"]
    return plans


def fit_features(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    imputed: bool = True,
    drop_first: bool = False,
    exactly: bool = False,
) -> FeaturePlan:
    """Fit on all given rows. ``imputed=False`` is for tables whose incomplete rows were dropped before, ``exactly`` takes moments whose bits do not depend on partitioning."""
    one = train.withColumn("fold", F.lit(0).cast("bigint"))
    found = (exact.moments(exact.cells(one, numeric, ["fold"]), ["fold"]) if exactly else stats.moments(one, numeric, ["fold"])) if numeric else None
    numbers = stats.mean_and_deviation(found, imputed) if numeric else None
    counts = stats.category_counts(one, categorical, ["fold"]) if categorical else None
    plans = _collect_plans(numbers, counts, numeric, categorical, drop_first)
    if 0 not in plans:
        raise ValueError("no rows to fit features on")
    return plans[0]


def train_moments_exactly(folded: DataFrame, folds: int, numeric: Sequence[str]) -> DataFrame:
    """Moments of the train rows of every fold, from exact sums."""
    return exact.moments(exact.train_cells(exact.cells(folded, numeric, ["fold"]), folds), ["fold"])


def fit_fold_features(
    folded: DataFrame, folds: int, numeric: Sequence[str], categorical: Sequence[str], imputed: bool = True, exactly: bool = False
) -> dict[int, FeaturePlan]:
    """Per fold, the fit on the rows of all other folds; two passes over the table in all. ``exactly`` as in :func:`fit_features`."""
    numbers = counts = None
    if numeric:
        found = train_moments_exactly(folded, folds, numeric) if exactly else stats.train_moments(stats.moments(folded, numeric, ["fold"]), folds)
        numbers = stats.mean_and_deviation(found, imputed)
    if categorical:
        counts = stats.train_category_counts(stats.category_counts(folded, categorical, ["fold"]), folds)
    return _collect_plans(numbers, counts, numeric, categorical, False, folds)


# --- the same steps as plain columns, for SQL-style use -------------------------------------------------


def fold_fit_stats(folded: DataFrame, folds: int, cols: Sequence[str], imputed: bool = False) -> DataFrame:
    """Train-side mean and deviation of every fold, one row per fold and column."""
    return stats.mean_and_deviation(stats.train_moments(stats.moments(folded, cols, ["fold"]), folds), imputed)


def fold_transform(
    folded: DataFrame, folds: int, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Every row as a test row: imputed and scaled with the train statistics of its own fold.

    The statistics are one row per fold, so joining them costs a broadcast of k rows.
    """
    numbers = fold_fit_stats(folded, folds, numeric, imputed=True)
    modes = stats.most_frequent(
        stats.train_category_counts(stats.category_counts(folded, categorical, ["fold"]), folds), ["fold"]
    )
    numbers = numbers.groupBy("fold").agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("mu"))).alias(f"_mu_{c}") for c in numeric],
        *[F.max(F.when(F.col("column_name") == c, F.col("sd"))).alias(f"_sd_{c}") for c in numeric],
    )
    modes = modes.groupBy("fold").agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("mode"))).alias(f"_mode_{c}") for c in categorical]
    )
    out = {f"{c}_scaled": scaled(F.coalesce(F.col(c), F.col(f"_mu_{c}")), F.col(f"_mu_{c}"), F.col(f"_sd_{c}"))
           for c in numeric}
    out |= {f"{c}_filled": F.coalesce(F.col(c), F.col(f"_mode_{c}")) for c in categorical}
    return (
        folded.join(F.broadcast(numbers), "fold", "left")
        .join(F.broadcast(modes), "fold", "left")
        .select(*folded.columns, *[e.alias(name) for name, e in out.items()])
    )


def transform_fold(
    folded: DataFrame, fold: int, plan: FeaturePlan, label: str, classes: Sequence[str], output: str = "features"
) -> DataFrame:
    """All rows for one fold with their role, features and target index."""
    role = F.when(F.col("fold") == fold, F.lit("test")).otherwise(F.lit("train"))
    return plan.pipeline(folded.sparkSession, output).transform(
        folded.withColumns({"role": role, "target": target_ordinal(label, classes)})
    )


def transform_all_folds(
    folded: DataFrame, folds: int, plans: dict[int, FeaturePlan], label: str, classes: Sequence[str]
) -> DataFrame:
    """The rows of every fold's train and test set, for a partitioned table.

    The table is read once: a join brings each category's codes in all folds, each row is repeated for every fold, and meets
    that fold's numbers (means, deviations, the first slot of each column), a row a fold, in a join that Spark broadcasts.
    """
    raw, views = coded_rows(folded.withColumn("target", target_ordinal(label, classes)), [plans[f] for f in range(folds)], "_raw")
    known = []
    for f, view in enumerate(views):
        numbers = [(int(c), float(m), float(d)) for c, m, d in zip(view.columns, view.means, view.deviations)]
        known.append((f, numbers, [(c, s.base, s.fill) for c, s in view.codes], view.width))
    table = folded.sparkSession.createDataFrame(
        known, "_fold bigint, _numbers array<struct<c:int,mu:double,sd:double>>, _codes array<struct<c:int,base:int,fill:int>>, _width int"
    )
    every = F.array(*[F.lit(f).cast("bigint") for f in range(folds)])
    rows = raw.withColumn("_fold", F.explode(every)).join(table, "_fold")

    def number(n: Column) -> Column:
        value = F.element_at("_raw", n["c"] + 1)
        return (F.when(F.isnan(value), n["mu"]).otherwise(value) - n["mu"]) / n["sd"]

    def slot(n: Column) -> Column:
        code = F.element_at("_raw", n["c"] + 1).cast("int")
        return F.when(code == MISSING, n["base"] + n["fill"]).when(code >= 0, n["base"] + code).otherwise(-1)

    first = F.size("_numbers")
    onehot = F.transform(
        F.sequence(first, F.col("_width") - 1), lambda j: F.when(F.array_contains("_hot", j), 1.0).otherwise(0.0)
    )
    onehot = F.when(F.col("_width") > first, onehot).otherwise(F.array().cast("array<double>"))
    rows = rows.withColumn("_hot", F.transform("_codes", slot))
    vector = array_to_vector(F.concat(F.transform("_numbers", number), onehot))
    role = F.when(F.col("fold") == F.col("_fold"), F.lit("test")).otherwise(F.lit("train"))
    kept = [c for c in folded.columns if c != "fold"]
    return rows.select(F.col("_fold").alias("fold"), role.alias("role"), *kept, "target", vector.alias("features"))


def target_ordinal(label: str, classes: Sequence[str]) -> Column:
    """Place of the label in the sorted class list; an unknown label is an error, not a class."""
    place = F.array_position(listed(classes), F.col(label).cast("string"))
    unknown = F.raise_error(F.concat(F.lit(f"unknown {label}: "), F.coalesce(F.col(label).cast("string"), F.lit("null"))))
    return F.when(place > 0, place - 1).otherwise(unknown).cast("bigint")


def target_onehot(label: str, classes: Sequence[str]) -> list[Column]:
    return [F.when(F.col(label) == c, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{label}_{c}") for c in classes]


def onehot_columns(column: str, vocabulary: Sequence[str], drop_first: bool = False) -> list[Column]:
    """One 0/1 column per known category; null and unknown values are zero everywhere."""
    return target_onehot(column, vocabulary[1:] if drop_first else vocabulary)


def onehot_array(column: str, vocabulary: Sequence[str], drop_first: bool = False) -> Column:
    kept = listed(vocabulary[1:] if drop_first else vocabulary)
    return F.transform(kept, lambda v: F.when(F.col(column).cast("string") == v, F.lit(1.0)).otherwise(F.lit(0.0)))
