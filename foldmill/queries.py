"""One runnable query per operator, each over the whole given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmill import fixtures as fx
from foldmill.functions.hashing import hash32
from foldmill.operators import clean, dense_net, dictionary, evaluate, exact, features, keys, model, score, split, stats, tune
from foldmill.session import new_folder, ship_package
from foldmill.sources import registry, runs, tables

FOLDS, IDS_PER_LIST = 5, 1000  # shorter lists than the flow's 10,000, so that small tables have several
WHEN = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def rounded(value: Column | str, digits: int) -> Column:
    """Rounded, with -0.0 turned into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def stored(df: DataFrame) -> DataFrame:
    """Write a table that several passes will read, so that its joins run once."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, "stored")
    tables.write_path(df, path)
    return tables.read_path(spark, path, df.schema)


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.kfold(stored(fx.samples(spark, sf_dir)), "id", FOLDS)


def learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = fx.LEARNABLE
    return stored(fx.samples(spark, sf_dir).select(cols.key, cols.label, *cols.numeric, *cols.categorical))


def fold_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(folded(spark, sf_dir).select("id", "fold"))
    pieces = split.list_pieces(rows.count(), FOLDS, IDS_PER_LIST)
    return split.fold_id_lists(rows, "id", FOLDS, pieces)


#: A fitted classifier with given numbers, so that its results can be stated in SQL: features of three numbers and one text column whose
#: vocabulary leaves out a value that occurs, and a network without hidden layers.
FIXED = features.FeaturePlan(
    ["price", "bal", "qty"], ["prio"],
    means={"price": 150000.0, "bal": 4500.0, "qty": 100.0}, deviations={"price": 80000.0, "bal": 3000.0, "qty": 50.0},
    fills={"prio": "2-HIGH"}, vocabulary={"prio": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
)
FIXED_WEIGHTS = [
    [1.0, -0.5, 0.0], [0.2, 0.1, -0.3], [0.3, 0.2, -0.1], [0.5, 0.0, 0.0], [0.0, 0.4, 0.1], [0.0, 0.0, 0.6], [0.1, 0.0, -0.1],
]
SCORED_INPUTS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("bal", T.DoubleType()),
    T.StructField("qty", T.DoubleType()), T.StructField("prio", T.StringType()), T.StructField("seg", T.StringType()),
])


def fixed_model(spark: SparkSession) -> PipelineModel:
    weights = [w for row in FIXED_WEIGHTS for w in row]
    net = dense_net.DenseNetModel(layers=[len(FIXED.names()), len(fx.CLASSES)], weights=weights)
    return PipelineModel([*FIXED.pipeline(spark).stages, net])


def fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All samples with the probabilities, prediction and confidence of the given classifier."""
    return model.predict(fixed_model(spark), fx.samples(spark, sf_dir), fx.CLASSES)


def fixed_batch(spark: SparkSession, rows: DataFrame, fitted: PipelineModel | None = None) -> DataFrame:
    """Raw rows (sentinels, nulls and unknown categories in them) through the scoring of the flows."""
    required = FIXED.numeric + FIXED.categorical
    return score.score_batch(fitted or fixed_model(spark), rows, required, fx.CLASSES, WHEN, fx.SENTINELS)


# --- reading and writing ---------------------------------------------------------------------------------

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("id", T.LongType()), ("label", T.StringType()), ("price", T.DoubleType()), ("bal", T.DoubleType()),
            ("qty", T.DoubleType()), ("disc", T.DoubleType()), ("prio", T.StringType()), ("seg", T.StringType()),
        ]
    ]
)
SAMPLE_COLUMNS = SAMPLE_SCHEMA.fieldNames()


@query
def csv_declared_schema(spark, sf_dir):
    path = new_folder(spark, "csv")
    tables.write_csv(fx.raw_samples(spark, sf_dir).select(*SAMPLE_COLUMNS), path)
    return clean.clean(tables.read_csv(spark, path, SAMPLE_SCHEMA), fx.SENTINELS)


@query
def csv_inferred_schema(spark, sf_dir):
    """Types found from the texts: numbers stay numeric beside sentinels, a column of ten-digit texts with one word is text."""
    path, rows = new_folder(spark, "csv"), fx.raw_samples(spark, sf_dir)
    texts = rows.select(
        "id", "label", F.coalesce(F.col("price").cast("string"), F.lit("NA")).alias("price"), F.coalesce(F.col("qty").cast("string"), F.lit(".")).alias("qty"),
        F.coalesce(F.col("n_lines").cast("int").cast("string"), F.lit("NA")).alias("n_lines"), F.when(F.col("seg") == "BUILDING", "NA").otherwise("true").alias("flag"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).cast("string").alias("day"),
        F.when(F.col("label") == "P", "unknown").otherwise(F.col("id").cast("string")).alias("mixed"), F.lit(".").alias("nothing"),
    )
    tables.write_csv(texts, path)
    return tables.infer_csv(spark, path)


@query
def table_by_path(spark, sf_dir):
    path = new_folder(spark, "table")
    tables.write_path(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), path)
    return tables.read_path(spark, path)


@query
def table_by_name(spark, sf_dir):
    path = new_folder(spark, "named")
    return tables.write_name(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), "foldmill_samples", path)


@query
def table_replace(spark, sf_dir):
    """A table replaced by a part of itself, and what a plan made before still counts."""
    name, root = "foldmill_replaced", new_folder(spark, "versions")
    rows = fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    before = tables.replace_name(rows, name, root).agg(F.count("*").alias("n_before"))
    after = tables.replace_name(tables.read_name(spark, name).filter("label <> 'F'"), name, root)
    return after.crossJoin(F.broadcast(before))  # one row


@query
def table_truncated(spark, sf_dir):
    """An emptied table keeps its columns; a plan made before still reads its rows."""
    name, root = "foldmill_emptied", new_folder(spark, "versions")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    before = tables.replace_name(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), name, root)
    after = tables.empty_name(spark, name, root)
    return before.agg(F.count("*").alias("n_before")).crossJoin(after.agg(F.count("*").alias("n_after"))).withColumn("columns", F.lit(",".join(after.columns)))


@query
def append_merge_schema(spark, sf_dir):
    path, rows = new_folder(spark, "batches"), fx.samples(spark, sf_dir)
    tables.append(rows.filter(F.col("label") == "F").select("id", "label", "qty"), path)
    tables.append(rows.filter(F.col("label") != "F").select("id", "label", "qty", "disc"), path)
    return tables.read_merged(spark, path)


@query
def snapshot_json(spark, sf_dir):
    path = new_folder(spark, "snapshot")
    tables.write_snapshot(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), path)
    return tables.read_snapshot(spark, path, SAMPLE_SCHEMA)


# --- projections, null handling, schema ------------------------------------------------------------------


@query
def sentinel_to_null(spark, sf_dir):
    return clean.sentinel_to_null(fx.raw_samples(spark, sf_dir), fx.SENTINELS).select("id", "prio")


@query
def drop_missing(spark, sf_dir):
    return clean.drop_missing(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS))


@query
def fill_constant(spark, sf_dir):
    return clean.fill_constant(fx.samples(spark, sf_dir), {"prio": "NA", "seg": "NA"}).select("id", "prio", "seg")


@query
def features_label_split(spark, sf_dir):
    """The input rows, and below them the target column with as many rows and nothing else."""
    inputs, target = clean.features_label_split(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), "label")
    return inputs.unionByName(target, allowMissingColumns=True)


@query
def select_by_type(spark, sf_dir):
    return clean.select_by_type(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), exclude=("id", "label"))


@query
def validate_schema(spark, sf_dir):
    required = ["price", "bal", "qty", "disc", "prio", "seg", "sex", "island"]
    return clean.validate_schema(fx.samples(spark, sf_dir), required)


@query
def conform_schema(spark, sf_dir):
    rows = fx.samples(spark, sf_dir)
    as_text = rows.select("seg", F.coalesce(F.col("qty").cast("string"), F.lit("NA")).alias("qty"), "prio",
                          F.col("id").cast("string").alias("id"))
    schema = T.StructType([f for f in SAMPLE_SCHEMA if f.name in ("id", "qty", "prio", "seg")])
    return clean.conform_schema(as_text, schema)


@query
def fold_train_rows(spark, sf_dir):
    return split.train_rows(folded(spark, sf_dir), 2).select("id", "fold")


@query
def fold_test_rows(spark, sf_dir):
    return split.test_rows(folded(spark, sf_dir), 2).select("id", "fold")


@query
def stamp_batch(spark, sf_dir):
    return clean.stamp_batch(fx.samples(spark, sf_dir).select("id"), WHEN)


@query
def decode_ids(spark, sf_dir):
    encoded = fold_lists(spark, sf_dir).select("fold", "role", F.to_json("ids").alias("encoded"))
    return clean.decode_ids(encoded, "encoded")


# --- joins -----------------------------------------------------------------------------------------------


@query
def rows_by_id_list(spark, sf_dir):
    wanted = fx.table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("id"))
    return split.rows_by_id_list(fx.samples(spark, sf_dir), wanted, "id").select("id", "label", "price")


@query
def attach_predictions(spark, sf_dir):
    predictions = fixed_predictions(spark, sf_dir)
    inputs = fx.samples(spark, sf_dir).select("id", "price", "seg")
    return score.attach_predictions(inputs, predictions, "id").withColumn("confidence", rounded("confidence", 6))


@query
def index_to_label(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", (hash32("id", 42) % 4).alias("class_index"))
    return score.index_to_label(rows, "class_index", fx.CLASSES)


@query
def join_folds(spark, sf_dir):
    path = new_folder(spark, "folds")
    tables.write_path(folded(spark, sf_dir).select("id", "fold"), path)
    return split.join_folds(fx.samples(spark, sf_dir), tables.read_path(spark, path), "id").select("id", "seg", "fold")


# --- aggregates ------------------------------------------------------------------------------------------


@query
def row_count(spark, sf_dir):
    return stats.row_count(fx.samples(spark, sf_dir))


@query
def describe(spark, sf_dir):
    out = stats.describe(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS), exclude=("id",))
    return out.withColumns({"mean": rounded("mean", 4), "sd": rounded("sd", 4)})


@query
def categories(spark, sf_dir):
    return stats.categories(fx.samples(spark, sf_dir), ["label", "prio", "seg"])


@query
def eval_accuracy_logloss(spark, sf_dir):
    out = evaluate.accuracy_and_loss(
        fixed_predictions(spark, sf_dir), "label", "prediction",
        evaluate.true_probability("probability", "label", fx.CLASSES),
    )
    return out.select("n_rows", rounded("accuracy", 6).alias("accuracy"), rounded("loss", 5).alias("loss"))


@query
def majority_share(spark, sf_dir):
    out = evaluate.majority_share(fx.samples(spark, sf_dir), "label")
    return out.select(rounded("majority_share", 6).alias("majority_share"))


@query
def confusion(spark, sf_dir):
    return evaluate.confusion(fixed_predictions(spark, sf_dir), "label", "prediction")


def fixed_fold_metrics(spark, sf_dir) -> DataFrame:
    """Long fold metrics of the fixed-score classifier."""
    scored = model.predict(fixed_model(spark), folded(spark, sf_dir), fx.CLASSES)
    per_fold = evaluate.accuracy_and_loss(
        scored, "label", "prediction", evaluate.true_probability("probability", "label", fx.CLASSES), ["fold"]
    )
    return per_fold.select(
        "fold", F.col("accuracy").alias("test_accuracy"), F.col("loss").alias("test_loss")
    ).unpivot("fold", ["test_accuracy", "test_loss"], "metric", "value")


@query
def cv_average(spark, sf_dir):
    return evaluate.cv_average(fixed_fold_metrics(spark, sf_dir)).withColumn("value", rounded("value", 6))


@query
def quality_gate(spark, sf_dir):
    gate = evaluate.quality_gate(evaluate.cv_average(fixed_fold_metrics(spark, sf_dir)), "test_accuracy", 0.7)
    return gate.withColumn("value", rounded("value", 6))


# --- splits and samples ----------------------------------------------------------------------------------


@query
def kfold_exact(spark, sf_dir):
    return folded(spark, sf_dir).select("id", "fold")


@query
def kfold_hash(spark, sf_dir):
    return split.kfold_by_hash(fx.samples(spark, sf_dir), "id", FOLDS).select("id", "fold")


@query
def fold_id_lists(spark, sf_dir):
    """The lists as JSON text, the form in which ``decode_ids`` takes them back."""
    return fold_lists(spark, sf_dir).withColumn("ids", F.to_json("ids"))


@query
def split_70_15_15(spark, sf_dir):
    return split.train_val_test(stored(fx.samples(spark, sf_dir).select("id")), "id").select("id", "part")


@query
def holdout_tail(spark, sf_dir):
    return split.holdout_tail(fx.samples(spark, sf_dir), "id").select("id", "is_holdout")


@query
def stable_shuffle(spark, sf_dir):
    return split.shuffled_positions(fx.samples(spark, sf_dir).select("id", "label"), "id")


@query
def sample_n(spark, sf_dir):
    return split.sample_n(fx.samples(spark, sf_dir).select("id", "label", "price"), "id", 5)


@query
def row_key(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return keys.with_row_key(lines)


# --- features --------------------------------------------------------------------------------------------


@query
def target_ordinal(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "label")
    return rows.select("id", features.target_ordinal("label", stats.class_list(rows, "label")).alias("target"))


@query
def target_onehot(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "label")
    return rows.select("id", *features.target_onehot("label", stats.class_list(rows, "label")))


@query
def impute_mean(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", "qty", "disc"))
    plan = features.fit_features(rows, ["qty", "disc"], [])
    filled = {c: rounded(F.coalesce(c, F.lit(plan.means[c])), 4) for c in ("qty", "disc")}
    return rows.select("id", *[e.alias(c) for c, e in filled.items()])


@query
def impute_mode(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "prio")
    plan = features.fit_features(rows, [], ["prio"])
    return rows.select("id", F.coalesce("prio", F.lit(plan.fills["prio"])).alias("prio"))


@query
def standard_scale(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", "price", "bal"))
    plan = features.fit_features(rows, ["price", "bal"], [])
    cols = [features.scaled(F.col(c), F.lit(plan.means[c]), F.lit(plan.deviations[c])) for c in ("price", "bal")]
    return rows.select("id", rounded(cols[0], 6).alias("price_scaled"), rounded(cols[1], 6).alias("bal_scaled"))


def _vocabulary(rows: DataFrame, column: str) -> list[str]:
    return features.fit_features(rows, [], [column]).vocabulary[column]


@query
def onehot(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "prio")
    cols = features.onehot_columns("prio", _vocabulary(rows, "prio"))
    return rows.select("id", *[c.alias(f"prio_{i}") for i, c in enumerate(cols)])


@query
def onehot_array(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "prio")
    return rows.select("id", F.to_json(features.onehot_array("prio", _vocabulary(rows, "prio"))).alias("slots"))


@query
def onehot_drop_first(spark, sf_dir):
    rows = fx.samples(spark, sf_dir).select("id", "seg")
    cols = features.onehot_columns("seg", _vocabulary(rows, "seg"), drop_first=True)
    return rows.select("id", *[c.alias(f"seg_{i + 1}") for i, c in enumerate(cols)])


def _slot_columns(df: DataFrame, kept: list[str], slots: int) -> DataFrame:
    out = df.withColumn("_a", vector_to_array("features"))
    return out.select(*kept, *[rounded(F.col("_a")[i], 6).alias(f"slot_{i:02d}") for i in range(slots)])


@query
def assemble_features(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", *fx.NUMERIC, *fx.CATEGORICAL))
    plan = features.fit_features(rows, fx.NUMERIC, fx.CATEGORICAL)
    return _slot_columns(plan.pipeline(spark).transform(rows), ["id"], len(plan.names()))


@query
def assemble_drop_first(spark, sf_dir):
    rows = split.train_val_test(stored(clean.drop_missing(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS))), "id")
    train = rows.filter(F.col("part") == "train")
    plan = features.fit_features(train, fx.NUMERIC, fx.CATEGORICAL, imputed=False, drop_first=True)
    return _slot_columns(plan.pipeline(spark).transform(rows), ["id", "part"], len(plan.names()))


def clerks(spark, sf_dir) -> DataFrame:
    """Orders with their customer's name: a text column with as many values as customers."""
    names = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), "c_name")
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("prio"))
    return stored(orders.join(names, "cust", "left").select("id", F.col("c_name").alias("name"), "prio"))


@query
def dictionary_codes(spark, sf_dir):
    """The code of each customer's name among those of all orders, and among those of the other folds' orders."""
    rows = split.kfold_by_hash(clerks(spark, sf_dir), "id", FOLDS)
    plans = features.fit_fold_features(rows, FOLDS, [], ["name"])
    whole = features.fit_features(rows, [], ["name"])
    coded = dictionary.encode(rows, whole.stored.table(spark), ["name"], ["codes"])
    coded = dictionary.encode(coded, plans[0].stored.table(spark), ["name"], ["fold_codes"], FOLDS)
    own = F.element_at("fold_codes", (F.col("fold") + 1).cast("int"))
    return coded.select("id", "fold", F.col("codes")[0].cast("bigint").alias("code"), own.cast("bigint").alias("code_in_fold"))


@query
def dictionary_onehot(spark, sf_dir):
    """Sparse one-hot vectors of names and priorities: the slots in use and the width."""
    rows = clerks(spark, sf_dir)
    plan = features.fit_features(rows, [], ["name", "prio"], drop_first=True)
    vector = F.to_json(F.struct("features"))
    out = plan.pipeline(spark).transform(rows)
    parsed = F.from_json(vector, "features struct<type:int,size:bigint,indices:array<bigint>,values:array<double>>")
    return out.select("id", parsed["features"].alias("v")).select("id", "v.size", F.to_json("v.indices").alias("slots"), F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query
def feature_names(spark, sf_dir):
    names = features.fit_features(fx.samples(spark, sf_dir), fx.NUMERIC, fx.CATEGORICAL).names()
    return spark.createDataFrame(list(enumerate(names)), "place bigint, name string")


@query
def fold_fit_stats(spark, sf_dir):
    out = features.fold_fit_stats(folded(spark, sf_dir), FOLDS, ["price", "qty"])
    return out.select("fold", "column_name", "n_rows", "n", rounded("mu", 4).alias("mu"), rounded("sd", 4).alias("sd"))


@query
def exact_moments(spark, sf_dir):
    """Per fold the train rows' moments from exact sums, unrounded."""
    out = features.train_moments_exactly(folded(spark, sf_dir), FOLDS, ["qty", "n_lines"])
    return out.select("fold", "column_name", "n_rows", "n", "mu", "m2")


@query
def exact_totals(spark, sf_dir):
    """The exact sums of the columns' doubles, in units of 2^-60."""
    cols = ["price", "bal", "disc", "peak"]
    return exact.moments(exact.cells(fx.samples(spark, sf_dir), cols)).select("column_name", "n_rows", "n", "units")


@query
def fold_transform(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", "price", "qty", "prio"))
    out = features.fold_transform(split.kfold(rows, "id", FOLDS), FOLDS, ["price", "qty"], ["prio"])
    return out.select(
        "id", "fold", rounded("price_scaled", 6).alias("price_scaled"), rounded("qty_scaled", 6).alias("qty_scaled"),
        "prio_filled",
    )


@query
def transform_fold(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", "label", "price", "qty", "prio"))
    rows = split.kfold(rows, "id", FOLDS)
    plan = features.fit_fold_features(rows, FOLDS, ["price", "qty"], ["prio"])[2]
    out = features.transform_fold(rows, 2, plan, "label", stats.class_list(rows, "label"))
    return _slot_columns(out, ["id", "role", "target"], len(plan.names()))


@query
def folds_partitioned(spark, sf_dir):
    rows = stored(fx.samples(spark, sf_dir).select("id", "label", "price", "qty", "prio"))
    rows, path = split.kfold(rows, "id", FOLDS), new_folder(spark, "folds")
    plans = features.fit_fold_features(rows, FOLDS, ["price", "qty"], ["prio"])
    out = features.transform_all_folds(rows, FOLDS, plans, "label", stats.class_list(rows, "label"))
    tables.write_folds(out, path)
    kept = _slot_columns(tables.read_path(spark, path), ["fold", "role", "id", "target"], len(plans[0].names()))
    return kept.withColumn("fold", F.col("fold").cast("bigint"))


# --- models ----------------------------------------------------------------------------------------------


def _network(**changes) -> dense_net.Training:
    return dense_net.Training(**({"hidden": list(model.HIDDEN)} | changes))


def _classes(rows: DataFrame) -> list[str]:
    return stats.class_list(rows, "band")


def _majority(rows: DataFrame) -> float:
    return evaluate.majority_share(rows, "band").first()[0]


def _weights(plan: features.FeaturePlan, hidden, classes) -> int:
    return dense_net.weight_count([plan.width, *hidden, len(classes)])


TRAINED = "n_train bigint, n_test bigint, n_features bigint, n_weights bigint, epochs bigint, beats_majority boolean"


@query
def mlp_fit(spark, sf_dir):
    """Fit on the train rows, scored on the tail: what was fitted on what, and whether it beats a constant prediction."""
    cols, rows = fx.LEARNABLE, learnable(spark, sf_dir)
    marked = split.holdout_tail(rows, "id")
    train, test = marked.filter("not is_holdout"), marked.filter("is_holdout")
    classes = _classes(rows)
    plan = features.fit_features(train, cols.numeric, cols.categorical)
    fitted = model.fit_perceptron(train, plan, cols, classes)
    tested = model.evaluate_model(fitted, test, "band", classes).first()
    row = (train.count(), tested["n_rows"], plan.width, fitted.stages[-1].weights.size, tested["accuracy"] > _majority(rows))
    return spark.createDataFrame([row], TRAINED.replace("epochs bigint, ", ""))


HISTORY_NUMERIC = ["qty", "n_lines", "peak", "price"]
HISTORY_EPOCHS, HISTORY_RATE = 5, 0.5


#: Settings that the SQL follows update by update.
SLICED = {"epochs": 2, "rate": HISTORY_RATE, "slices": 3}
DROPPED = {"epochs": 1, "rate": HISTORY_RATE, "slices": 2, "dropout": 0.3}


def _history(spark, sf_dir, calls=(None,), **changes) -> DataFrame:
    """The history of one network, trained by a call for each of ``calls`` (the most epochs it runs) that takes up the last one's state."""
    cols = model.Columns("id", "band", HISTORY_NUMERIC, [])
    rows = stored(fx.samples(spark, sf_dir).select("id", "band", *HISTORY_NUMERIC))
    rows = split.holdout_tail(rows, "id", name="held_out")
    plan = features.fit_features(rows.filter("not held_out"), HISTORY_NUMERIC, [])
    job = model.Job(plan, _network(optimizer="sgd", **changes), (1,))
    state = new_folder(spark, "state") if len(calls) > 1 else None
    for most in calls:
        [fitted] = model.fit_dense(rows, cols, _classes(rows), [job], F.col("held_out").cast("long"), state=state, most=most)
    names = ["train_loss", "train_accuracy", "val_loss", "val_accuracy"]
    return dense_net.history_rows(spark, fitted).select("step", *[rounded(n, 5).alias(n) for n in names])


@query
def train_history(spark, sf_dir):
    return _history(spark, sf_dir, epochs=HISTORY_EPOCHS, rate=HISTORY_RATE)


@query
def train_resumed(spark, sf_dir):
    """The same training cut off after two epochs and taken up again from its stored state."""
    return _history(spark, sf_dir, (2, None), epochs=HISTORY_EPOCHS, rate=HISTORY_RATE)


@query
def train_slices(spark, sf_dir):
    """Three updates an epoch, each over a slice of the rows."""
    return _history(spark, sf_dir, **SLICED)


@query
def train_dropout(spark, sf_dir):
    """The same with hidden units masked by hashes of seed, epoch, key and unit."""
    return _history(spark, sf_dir, **DROPPED)


def _held_out_job(spark, sf_dir, *settings: dense_net.Training):
    """Networks on all but the tail; returns rows, classes, plan and the fits."""
    cols, rows = fx.LEARNABLE, split.holdout_tail(learnable(spark, sf_dir), "id", name="held_out")
    plan = features.fit_features(rows.filter("not held_out"), cols.numeric, cols.categorical)
    classes = _classes(rows)
    fits = model.fit_dense(rows, cols, classes, [model.Job(plan, s, (1,)) for s in settings], F.col("held_out").cast("long"))
    return rows, classes, plan, *fits


@query
def train_minibatch(spark, sf_dir):
    """Five epochs of eight updates, and beside them, by the same passes, five epochs of one update over the whole table."""
    rows, classes, plan, fitted, whole = _held_out_job(spark, sf_dir, _network(epochs=5, slices=8), _network(epochs=5))
    last = fitted.history[-1]
    row = (fitted.train_rows, fitted.held_rows, plan.width, len(fitted.weights), len(fitted.history), fitted.updates,
           last["val_accuracy"] > _majority(rows), last["val_loss"] < 0.9 * whole.history[-1]["val_loss"])
    return spark.createDataFrame([row], TRAINED.replace("beats_majority", "updates bigint, beats_majority") + ", beats_whole_table boolean")


@query
def early_stop_fit(spark, sf_dir):
    """Training with steps so large that the held-out loss rises: it stops early and keeps the weights of its best epoch."""
    rows, classes, plan, fitted = _held_out_job(spark, sf_dir, _network(optimizer="sgd", rate=6.0, patience=2))
    losses = [h["val_loss"] for h in fitted.history]
    best = min(range(len(losses)), key=losses.__getitem__)
    kept = model.evaluate_model(model.as_pipeline(spark, plan, fitted), rows.filter("held_out"), "band", classes).first()
    row = (kept["n_rows"], len(losses) < _network().epochs, fitted.best_epoch == best, len(losses) - 1 - best == 2,
           abs(kept["loss"] - losses[best]) < 1e-9)
    return spark.createDataFrame([row], "n_test bigint, stopped_early boolean, kept_best_epoch boolean, after_patience boolean, weights_restored boolean")


@query
def early_stop_epoch(spark, sf_dir):
    """Loss curves per fold, from the fixed scores weighted by a slope that grows with the step."""
    rows = folded(spark, sf_dir)
    losses = []
    for step in range(10):
        slope = (step - 4) / 10.0
        scores = [F.col("price") / 100000.0 * slope, F.col("bal") / 10000.0 * slope, F.lit(0.0)]
        p = evaluate.true_probability(evaluate.softmax(scores), "label", fx.CLASSES)
        losses.append(F.avg(evaluate.row_loss(p)).alias(str(step)))
    wide = rows.groupBy("fold").agg(*losses)
    history = wide.unpivot("fold", [str(s) for s in range(10)], "step", "val_loss")
    history = history.withColumn("step", F.col("step").cast("bigint"))
    return evaluate.early_stop(history, "fold", patience=3).withColumn("best_loss", rounded("best_loss", 5))


@query
def cv_metrics(spark, sf_dir):
    """All folds at full epochs: rows tested, epochs run, and whether the fold beats a constant prediction."""
    rows = stored(split.kfold(learnable(spark, sf_dir), "id", FOLDS))
    share = _majority(rows)
    results = model.cross_validate(rows, FOLDS, fx.LEARNABLE, _classes(rows), _network())
    found = [(r["fold"], r["n_test"], len(r["history"]), r["test_accuracy"] > share) for r in results]
    return spark.createDataFrame(found, "fold bigint, n_test bigint, epochs bigint, beats_majority boolean")


@query
def final_model(spark, sf_dir):
    """Train, register, load the newest version and score the whole table with it: what the version knows, and what it scored."""
    rows, root = learnable(spark, sf_dir), new_folder(spark, "registry")
    classes = _classes(rows)
    fitted, _, plan, scores = model.final_model(rows, fx.LEARNABLE, classes, _network())
    registry.register(spark, root, "band_classifier", fitted, "run-1", plan.names(), classes, WHEN)
    loaded, row = registry.load_latest(spark, root, "band_classifier")
    required = fx.LEARNABLE.numeric + fx.LEARNABLE.categorical
    scored = score.score_batch(loaded, rows, required, row["target_classes"], WHEN, fx.SENTINELS)
    hits = F.avg((F.col("band") == F.col("prediction")).cast("double"))
    return scored.groupBy().agg(F.count("prediction").alias("n_scored"), (hits > _majority(rows)).alias("beats_majority")).select(
        F.lit(row["version"]).cast("bigint").alias("version"), F.lit(len(row["feature_names"])).cast("bigint").alias("n_features"),
        F.lit(scores["train_rows"]).cast("bigint").alias("n_train"), F.lit(scores["holdout_rows"]).cast("bigint").alias("n_holdout"),
        "n_scored", "beats_majority",
    )


@query
def registry_round_trip(spark, sf_dir):
    """Two versions registered, the newest loaded with its metadata and applied to all raw rows."""
    root, fitted = new_folder(spark, "registry"), fixed_model(spark)
    older = PipelineModel([*FIXED.pipeline(spark).stages, dense_net.DenseNetModel(layers=[6, 3], weights=[0.0] * 21)])
    registry.register(spark, root, "fixed", older, "run-1", ["none"], ["?"], WHEN)
    registry.register(spark, root, "other", older, "run-2", ["none"], ["?"], WHEN)
    registry.register(spark, root, "fixed", fitted, "run-3", FIXED.names(), fx.CLASSES, WHEN)
    loaded, row = registry.load_latest(spark, root, "fixed")
    scored = fixed_batch(spark, fx.raw_samples(spark, sf_dir), loaded)
    return scored.groupBy("prediction").agg(F.count("*").alias("n")).select(
        F.lit(row["version"]).cast("bigint").alias("version"), F.lit(row["run_id"]).alias("run_id"),
        F.lit(",".join(row["target_classes"])).alias("target_classes"), F.lit(",".join(row["feature_names"])).alias("feature_names"),
        "prediction", "n",
    )


@query
def score_batch(spark, sf_dir):
    scored = fixed_batch(spark, fx.raw_samples(spark, sf_dir))
    return scored.select("id", "prediction", rounded("confidence", 6).alias("confidence"), "prediction_time")


@query
def capture_predictions(spark, sf_dir):
    """Batches of unlike types in one log: the second brings whole numbers and a column more, the third is not logged."""
    path, raw = new_folder(spark, "predictions"), fx.raw_samples(spark, sf_dir).select(*SAMPLE_COLUMNS, "n_lines")
    inputs = [f.name for f in SCORED_INPUTS]
    predicted = ["prediction", "confidence", "prediction_time"]
    batches = [
        (fixed_batch(spark, raw.filter("label <> 'P'")), inputs, True),
        (fixed_batch(spark, raw.filter("label = 'P'")).withColumn("qty", F.col("qty").cast("int"))
         .withColumn("n_lines", F.col("n_lines").cast("int")), [*inputs, "n_lines"], True),
        (fixed_batch(spark, raw.filter("label = 'O'")), inputs, False),
    ]
    for scored, kept, enabled in batches:
        score.capture(scored.select(*kept, *predicted), path, SCORED_INPUTS.fields, enabled)
    return score.read_log(spark, path).withColumn("confidence", rounded("confidence", 6))


@query
def capture_once(spark, sf_dir):
    """Two batches in a log: one captured twice, the other after an attempt that wrote its rows and failed before it was committed."""
    path, raw = new_folder(spark, "predictions"), fx.raw_samples(spark, sf_dir).select(*SAMPLE_COLUMNS)
    kept = [*[f.name for f in SCORED_INPUTS], "prediction", "confidence", "prediction_time"]
    first, second = (fixed_batch(spark, raw.filter(f"label {sign} 'P'")).select(*kept) for sign in ("<>", "="))
    for _ in range(2):
        score.capture(first, path, SCORED_INPUTS.fields, batch="first")
    score.write_attempt(score.log_rows(second, SCORED_INPUTS.fields), path, "second")
    score.capture(second, path, SCORED_INPUTS.fields, batch="second")
    return score.read_log(spark, path).withColumn("confidence", rounded("confidence", 6))


@query
def prediction_report(spark, sf_dir):
    """A few sampled rows, true class beside predicted class."""
    scored = fixed_batch(spark, split.sample_n(fx.raw_samples(spark, sf_dir), "id", 5))
    return scored.select("id", "label", "prediction", rounded("confidence", 6).alias("confidence"))


# --- search ----------------------------------------------------------------------------------------------


@query
def trial_grid(spark, sf_dir):
    parts = split.train_val_test(clean.drop_missing(fx.samples(spark, sf_dir).select(*SAMPLE_COLUMNS)), "id")
    out = tune.search_plan(tune.trial_grid(spark, 5), parts.select("id", "part"))
    return out.withColumn("learning_rate", rounded("learning_rate", 8))


def fixed_trial_results(spark, sf_dir) -> DataFrame:
    """Scores of the fixed-score classifier per trial and execution, where a trial sets how steep its scores are."""
    rows = split.train_val_test(fx.samples(spark, sf_dir), "id")
    rows = rows.filter(F.col("part") == "val")
    aggs = []
    for trial in range(3):
        for execution in range(2):
            slope = (trial + 1) * 0.5 - execution * 0.25
            p = evaluate.softmax([F.col("price") / 100000.0 * slope, F.col("bal") / 10000.0, F.lit(slope)])
            p_true = evaluate.true_probability(p, "label", fx.CLASSES)
            hit = F.when(p_true == F.array_max(p), 1.0).otherwise(0.0)
            loss = evaluate.row_loss(p_true)
            aggs += [F.struct(
                F.lit(trial).cast("bigint").alias("trial"), F.lit(execution).cast("bigint").alias("execution"),
                F.lit(name).alias("metric"), F.avg(value).alias("value"),
            ) for name, value in (("val_accuracy", hit), ("val_loss", loss))]
    return rows.agg(F.array(*aggs).alias("results")).select(F.inline("results"))


@query
def trial_reduce(spark, sf_dir):
    return evaluate.trial_reduce(fixed_trial_results(spark, sf_dir)).withColumn("value", rounded("value", 6))


@query
def best_trial(spark, sf_dir):
    reduced = evaluate.trial_reduce(fixed_trial_results(spark, sf_dir))
    return evaluate.best_trial(reduced).withColumn("value", rounded("value", 6))


def _searched(spark, sf_dir):
    """The whole search with the drawn settings: parts, classes and what was found."""
    cols = fx.LEARNABLE
    parts = stored(split.train_val_test(clean.drop_missing(learnable(spark, sf_dir)), "id"))
    classes = _classes(parts)
    return parts, classes, tune.search(parts, cols, classes, 5)


@query
def tune_trials(spark, sf_dir):
    """What each trial reports: four scores in their ranges, at the drawn settings, and whether its training loss falls."""
    _, _, found = _searched(spark, sf_dir)
    sane = F.when(F.col("metric").endswith("accuracy"), F.col("value").between(0.0, 1.0)).otherwise(F.col("value").between(0.0, 20.0))
    grid = tune.trial_grid(spark, 5).select("trial", "units", "epochs")
    results = found["results"].groupBy("trial", "execution").agg(F.count("*").alias("n_metrics"), F.min(sane).alias("in_range"))
    learned = [(t, slices, first - last > 0.02 * first) for t, slices, first, last in found["losses"]]
    return results.join(grid, "trial").join(spark.createDataFrame(learned, "trial bigint, updates_per_epoch bigint, loss_falls boolean"), "trial")


@query
def tune_winner(spark, sf_dir):
    """The best trial refitted with its own settings and scored on the test part."""
    parts, classes, found = _searched(spark, sf_dir)
    scores = found["results"].filter("metric = 'val_accuracy'")
    top = scores.groupBy("trial").agg(F.max("value").alias("v")).orderBy(F.desc("v"), "trial").first()["trial"]
    best, fitted = found["best"], found["fitted"]
    row = (found["test"]["n_rows"], found["plan"].width, best["trial"] == top, fitted.layers[1:-1] == [best["units"]],
           len(fitted.history) <= best["epochs"], found["test"]["accuracy"] > _majority(parts))
    return spark.createDataFrame([row], "n_test bigint, n_features bigint, is_best boolean, own_units boolean, within_epochs boolean, beats_majority boolean")


# --- run records and registry ----------------------------------------------------------------------------


@query
def run_params(spark, sf_dir):
    rows, run = fx.samples(spark, sf_dir), runs.Run("start", WHEN, run_id="run-1")
    run.param("n_samples", stats.row_count(rows).first()[0])
    for r in stats.categories(rows, ["label", "prio", "seg"]).groupBy("column_name").count().collect():
        run.param(f"n_{r['column_name']}", r["count"])
    return runs.run_rows(spark, [run]).filter("kind = 'param'")


def _fold_runs(spark, sf_dir) -> list[runs.Run]:
    parent = runs.Run("cross-validation", WHEN, run_id="cv")
    children = {f: runs.Run(f"cross-validation-cv-{f}", WHEN, parent, f"cv-{f}") for f in range(FOLDS)}
    for r in fixed_fold_metrics(spark, sf_dir).collect():
        children[r["fold"]].metric(r["metric"], r["value"], r["fold"])
    return [parent, *children.values()]


@query
def run_metrics(spark, sf_dir):
    table = runs.run_rows(spark, _fold_runs(spark, sf_dir)).filter("kind = 'metric'")
    return table.withColumn("num", rounded("num", 6))


@query
def run_rollup(spark, sf_dir):
    return runs.rollup(runs.run_rows(spark, _fold_runs(spark, sf_dir))).withColumn("avg_num", rounded("avg_num", 6))


@query
def run_tree(spark, sf_dir):
    """The runs of a whole job, four levels deep: the job, its cross-validation, the folds, and a run for each class of a fold."""
    scored = model.predict(fixed_model(spark), folded(spark, sf_dir), fx.CLASSES)
    p_true = evaluate.true_probability("probability", "label", fx.CLASSES)
    per_class = evaluate.accuracy_and_loss(scored, "label", "prediction", p_true, ["fold", "label"]).collect()  # a row a fold and class
    job, (cv, *children) = runs.Run("job", WHEN, run_id="job"), _fold_runs(spark, sf_dir)
    cv.parent, records = job, [job, cv, *children]
    cv.records = [(r[0], job.run_id, *r[2:]) for r in cv.records]
    for r in per_class:
        child = runs.Run(f"class-{r['label']}", WHEN, children[r["fold"]], f"cv-{r['fold']}-{r['label']}")
        child.metric("class_accuracy", r["accuracy"])
        records.append(child)
    return runs.run_tree(runs.run_rows(spark, records)).withColumns({"avg_num": rounded("avg_num", 6), "depth": F.col("depth").cast("bigint")})


@query
def registry_latest(spark, sf_dir):
    """A registry with one version per order: the newest version of each segment's model."""
    rows = fx.samples(spark, sf_dir)
    versions = rows.select(
        F.col("seg").alias("name"), F.col("id").alias("version"),
        F.concat(F.lit("models/"), "seg", F.lit("/"), F.col("id").cast("string")).alias("path"),
        F.concat(F.lit("run-"), "label").alias("run_id"),
    )
    return registry.latest(versions)
