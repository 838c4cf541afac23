"""Income model: training-set preparation, split, random forest, metrics,
importances and prediction.

One constant feature order (D4) is used for training and for prediction,
through the saved pipeline; the split is a seeded hash (repeatable on any
partitioning) and the saved artefact is the *fitted* pipeline.

Bagging is a seeded hash too: a row weighs as much in a tree as a draw from
Poisson(1) by the hash of tree and row says.  Spark's own forest draws by
partition; here a row has the same weight on every layout, and SQL can compute
it.  Each tree is one of Spark's weighted decision trees over all features; the
trees are fitted side by side and put together into Spark's forest model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.functions.numeric import dbl
from clientincome.operators.sampling import hash_bucket
from clientincome.sources import io

FEATURES = ("saldo", "potencial", "recorrido", "edad")
MIN_AGE, MAX_AGE = 18, 100  # fixed values: half-open training age range
TRAIN_SHARE = 80            # percent of rows in the training split
NUM_TREES, MAX_DEPTH, MAX_BINS = 20, 5, 32  # fixed values: the defaults the original relies on
ROWS_PER_PART = 500_000     # of the training rows
TREES_AT_ONCE = 8           # fits submitted together; they share the executors
# chances of at most 0, 1, 2, .. draws from Poisson(1)
_POISSON = tuple(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8))


def log_target(x) -> F.Column:
    return F.log10(dbl(x) + F.lit(1.0))


def inverse_log_target(x) -> F.Column:
    return F.pow(F.lit(10.0), dbl(x)) - F.lit(1.0)


def prepare(train_features: DataFrame, target: str = "mto_ing_mes") -> DataFrame:
    """Features + ``log_<target>``; whole-row dedupe; ages in [18, 100) (M1)."""
    label = f"log_{target}"
    return (
        train_features.select(target, *FEATURES)
        .withColumn(label, log_target(target))
        .drop(target)
        .dropDuplicates()
        .where((F.col("edad") >= MIN_AGE) & (F.col("edad") < MAX_AGE))
    )


def split_flag(df: DataFrame, seed: int = 123, share: int = TRAIN_SHARE) -> DataFrame:
    """Adds ``is_train``: seeded md5 bucket of the feature values < share (M3)."""
    return df.withColumn("is_train", hash_bucket(seed, list(FEATURES)) < share)


def split(df: DataFrame, seed: int = 123, share: int = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, seed, share)
    return (
        flagged.where(F.col("is_train")).drop("is_train"),
        flagged.where(~F.col("is_train")).drop("is_train"),
    )


def tree_weight(tree: int, seed: int) -> F.Column:
    """How often a row is drawn for ``tree``: Poisson(1) of 32 bits of the md5 of seed, tree and features."""
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}:{tree}"), *[F.col(c).cast("string") for c in FEATURES]))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    draws = F.lit(0)
    for chance in _POISSON:
        draws = draws + F.when(u >= chance, 1).otherwise(0)
    return draws.cast("double")


def fixed_layout(training: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """The training rows in a layout that does not depend on shuffle timing.

    Rows are hash-partitioned on all their columns (they are distinct after
    ``prepare``, so no value combination concentrates), then sorted within.
    Sums then add up in one order, and of more rows than MLlib samples for its
    thresholds the same are sampled.  The number of parts goes by the number of
    rows (ROWS_PER_PART each) and by no setting of the session.
    """
    cols = [*FEATURES, label]
    parts = partitions or 1 + training.count() // ROWS_PER_PART
    return training.repartition(parts, *cols).sortWithinPartitions(*cols)


def fit_forest(
    training: DataFrame, label: str, seed: int = 123, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS
) -> PipelineModel:
    """VectorAssembler and a forest of weighted decision trees (M2, M4).

    A feature of at most ``max_bins`` distinct values is split between any two
    of them, a finer one at so many quantiles.
    """
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
    weights = [tree_weight(t, seed).alias(f"_w{t}") for t in range(num_trees)]
    rows = assembler.transform(training.select("*", *weights)).select("features", label, *[f"_w{t}" for t in range(num_trees)]).persist()
    rows.count()

    def fit(t: int) -> DecisionTreeRegressionModel:
        tree = DecisionTreeRegressor(labelCol=label, weightCol=f"_w{t}", maxDepth=max_depth, maxBins=max_bins, seed=seed)
        return tree.fit(rows.where(F.col(f"_w{t}") > 0))

    with ThreadPoolExecutor(TREES_AT_ONCE) as pool:
        trees = list(pool.map(fit, range(num_trees)))
    rows.unpersist()
    return PipelineModel([assembler, _forest_of(trees)])


def _forest_of(trees: list[DecisionTreeRegressionModel]) -> RandomForestRegressionModel:
    """Spark's forest model of fitted trees: the mean of their predictions."""
    sc = SparkContext._active_spark_context
    java = sc._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(java.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t._java_obj
    forest = java.RandomForestRegressionModel(trees[0].uid.replace("DecisionTree", "RandomForest"), array, len(FEATURES))
    forest.set(forest.numTrees(), len(trees))
    return RandomForestRegressionModel(forest)


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: n, rmse, mse, mae, r2, explained variance (M7, M8)."""
    y, p = dbl(label), dbl(prediction)
    err = p - y
    m = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(y).alias("var_y"),
        F.var_pop(p).alias("var_p"),
        F.avg(p).alias("mean_p"),
        F.avg(y).alias("mean_y"),
    )
    return m.select(
        "n",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        F.when(F.col("var_y") > 0, F.lit(1.0) - F.col("mse") / F.col("var_y")).alias("r2"),
        # mean((prediction - mean(label))^2), as Spark's evaluators define it
        (F.col("var_p") + (F.col("mean_p") - F.col("mean_y")) * (F.col("mean_p") - F.col("mean_y"))).alias("explained_variance"),
    )


def train(
    train_features: DataFrame,
    model_path: str,
    target: str = "mto_ing_mes",
    seed: int = 123,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    max_bins: int = MAX_BINS,
    predictions_path: str | None = None,
    layout_partitions: int | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on the training split, predict the test split, save the fitted
    pipeline (M10).  Returns (model, test predictions, one-row status).

    ``predictions_path``: also write the test predictions as CSV with a
    header (S6), in parallel part files and apart from the model folder; the
    predictions returned, and the status, are then those read back.
    """
    label = f"log_{target}"
    data = prepare(train_features, target)
    training, test = split(data, seed)
    model = fit_forest(fixed_layout(training, label, layout_partitions), label, seed, num_trees, max_depth, max_bins)
    model.write().overwrite().save(model_path)
    predictions = model.transform(test).select(*FEATURES, label, "prediction")
    if predictions_path:
        io.write_csv(predictions, predictions_path)
        predictions = io.read_csv(train_features.sparkSession, predictions_path, predictions.schema)
    status = regression_metrics(predictions, label).select(
        F.lit("success").alias("status"), F.lit(model_path).alias("path_model"), "n", "rmse"
    )
    return model, predictions, status


def feature_importances(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, importance) pairs of the fitted forest (M5)."""
    forest = model.stages[-1]
    return [(f, float(v)) for f, v in zip(FEATURES, forest.featureImportances.toArray())]


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_income(clients: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``regr``: ``10^prediction - 1`` for deposit clients, 0 for the
    rest (M9).  One pass: ``transform`` appends the prediction to every row,
    no split, positional concat or union."""
    pred = model.transform(clients)
    out = pred.withColumn(
        "regr",
        F.when(F.col("ind_activo_cap") == 1, inverse_log_target("prediction")).when(
            F.col("ind_activo_cap") == 0, F.lit(0.0)
        ),
    )
    return out.drop("features", "prediction")


def linear_income(clients: DataFrame, coefs: Sequence[float]) -> DataFrame:
    """Adds ``regr`` from a fixed linear formula of the model features (a
    deterministic stand-in for the forest where a model cannot be used, e.g.
    in SQL cross-checks): c0 + c1*saldo + c2*potencial + c3*recorrido + c4*edad."""
    c0, *cs = [float(c) for c in coefs]
    expr = F.lit(c0)
    for c, f in zip(cs, FEATURES):
        expr = expr + F.lit(c) * dbl(f)
    return clients.withColumn(
        "regr",
        F.when(F.col("ind_activo_cap") == 1, expr).when(F.col("ind_activo_cap") == 0, F.lit(0.0)),
    )


def split_by_deposit_flag(clients: DataFrame) -> DataFrame:
    """Deposit clients and the others as one table (U1): the original splits
    on ``ind_activo_cap`` and unions the parts back; rows with other flag
    values drop out, as there.  One filter gives the same rows in one pass."""
    return clients.where(F.col("ind_activo_cap").isin(0, 1))
