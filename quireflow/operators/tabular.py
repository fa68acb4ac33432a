"""Retraining on tabular data: select, coerce, impute, one-hot, scale, forest."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireflow.session import fresh_dir, stored

IMPUTER_STRATEGY = {"mean": "mean", "median": "median", "most_frequent": "mode"}


def column_list(value: Column) -> Column:
    """A stored list literal (single or double quotes) as an array of names."""
    return F.from_json(F.translate(value, "'", '"'), "array<string>")


def select_named(df: DataFrame, stored: str, always: Sequence[str] = ()) -> DataFrame:
    """The columns a stored list literal names, after those always wanted."""
    return df.select(*always, *json.loads(stored.replace("'", '"')))


def as_bool(value: str) -> bool:
    """Logged booleans are text; anything but ``true`` is false."""
    return value.strip().lower() == "true"


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numbers where the text is one, null otherwise."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in columns})


def impute(train: DataFrame, columns: Sequence[str], strategy: str = "mean"):
    """Fitted imputer that fills the columns in place; fit on training rows only."""
    return Imputer(
        inputCols=list(columns), outputCols=list(columns), strategy=IMPUTER_STRATEGY[strategy]
    ).fit(train)


def exact_median(df: DataFrame, column: str) -> float | None:
    """Middle value, or the mean of the middle two, whatever the number of rows.

    Equal values are counted first, so a value that many rows share is one row. The counts
    are sorted across the cluster and added up by partition: the middle lies where the rows
    so far reach it, and two rows at most are fetched.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = stored(counts.orderBy("v").withColumn("p", F.spark_partition_id()), "counts")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = placed.groupBy("p").agg(F.sum("n").alias("_n")).select(
        "p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranged = placed.join(parts, "p").withColumn(
        "_from", F.col("_start") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    total = placed.agg(F.sum("n")).first()[0] or 0
    middle = [F.lit((total - 1) // 2), F.lit(total // 2)]
    holds = [(F.col("_from") <= m) & (m < F.col("_from") + F.col("n")) for m in middle]
    return ranged.where(holds[0] | holds[1]).agg(F.avg("v").alias("m")).first()["m"]


def impute_exact_median(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of ``df`` with the exact medians of the training rows."""
    medians = {c: exact_median(train, c) for c in columns}
    return df.na.fill({c: m for c, m in medians.items() if m is not None})


def one_hot_stages(columns: Sequence[str], handle_unknown: str = "ignore") -> list:
    """Index and one-hot. With ``ignore`` unseen values become all zeros: they share an
    extra last index, and the encoder leaves the last one out."""
    unseen = {"ignore": "keep", "error": "error"}[handle_unknown]
    index = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_ix" for c in columns],
        handleInvalid=unseen, stringOrderType="alphabetAsc",
    )
    hot = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in columns], outputCols=[f"{c}_hot" for c in columns],
        dropLast=(unseen == "keep"),
    )
    return [index, hot]


def scale_params(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, in one pass; one row comes back."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}_m") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
    ).first()
    return {c: (row[f"{c}_m"], row[f"{c}_s"]) for c in columns}


def standardise(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Zero mean and unit deviation; a constant column only loses its mean."""
    return df.withColumns({
        c: (F.col(c) - F.lit(mean)) / F.lit(dev if dev else 1.0) for c, (mean, dev) in params.items()
    })


def feature_stages(
    params: Mapping[str, str], numeric: Sequence[str], categorical: Sequence[str], passthrough: Sequence[str] = (),
) -> list:
    """Impute, one-hot and route columns into the vector ``assembled``: numbers first, then
    the one-hot groups, then what the parameters let through."""
    numeric, categorical = list(numeric), list(categorical)
    rest = list(passthrough) if params.get("preprocessor__remainder") == "passthrough" else []
    imputer = Imputer(
        inputCols=numeric, outputCols=numeric,
        strategy=IMPUTER_STRATEGY[params["preprocessor__numerical__imputer__strategy"]],
    )
    hot = one_hot_stages(categorical, params["preprocessor__onehot__handle_unknown"])
    assemble = VectorAssembler(
        inputCols=numeric + [f"{c}_hot" for c in categorical] + rest,
        outputCol="assembled", handleInvalid="keep",
    )
    return [imputer, *hot, assemble]


def forest_pipeline(
    params: Mapping[str, str], numeric: Sequence[str], categorical: Sequence[str], target: str,
    passthrough: Sequence[str] = (),
) -> Pipeline:
    """The retraining pipeline, configured by logged (text) parameters.

    Leaf and split fractions: Spark has a weight fraction per leaf, which is the leaf
    parameter; the split fraction has no counterpart beyond it.
    """
    # Divides by the sample deviation. ``standardise`` has the population one; the constant
    # factor between them changes no split of a tree.
    scale = StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True)
    features = float(params["regressor__max_features"])
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol="prediction",
        numTrees=int(params["regressor__n_estimators"]),
        maxDepth=int(params["regressor__max_depth"]),
        featureSubsetStrategy="all" if features >= 1.0 else str(features),
        minWeightFractionPerNode=float(params["regressor__min_samples_leaf"]),
        bootstrap=as_bool(params["regressor__bootstrap"]),
        impurity="variance",
        seed=int(params["regressor__random_state"]),
    )
    return Pipeline(stages=[*feature_stages(params, numeric, categorical, passthrough), scale, forest])


def retrain(
    train: DataFrame, params: Mapping[str, str], numeric: Sequence[str],
    categorical: Sequence[str], target: str, passthrough: Sequence[str] = (),
) -> PipelineModel:
    ready = coerce_numeric(train, numeric)
    return forest_pipeline(params, numeric, categorical, target, passthrough).fit(ready)


def forest_nodes(spark: SparkSession, forest: RandomForestRegressionModel) -> DataFrame:
    """The trees of a fitted forest as rows ``tree, node, value, rows, feature, threshold, left,
    right``. A node's ``value`` is the mean of its ``rows`` training rows; leaves have no feature.
    A row goes to the left where the entry ``feature`` of its vector is at most the threshold.
    Splits by unordered categories, which the one-hot vector of ``forest_pipeline`` never has,
    are refused.
    """
    path = fresh_dir(spark, "forest")
    forest.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    ordered = F.when(split["numCategories"] < 0, split["leftCategoriesOrThreshold"][0]).otherwise(
        F.raise_error(F.lit("a split by unordered categories")))
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["prediction"].alias("value"),
        node["rawCount"].alias("rows"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, ordered).alias("threshold"), F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"))


def walk_forest(nodes: DataFrame, rows: DataFrame, key: str, vector: str = "features", depth: int = 30) -> DataFrame:
    """``key, leaves array<int>, prediction`` of each row, by following its vector from node to
    node; ``key`` is unique. ``depth`` is the forest's depth or more.

    The paths stay columns of the row: a tree's nodes are one array, in order of node number, and
    the trees are one row that goes to every task. That row is bounded by the model, which the
    driver holds and Spark itself sends to every task to predict.
    """
    node = F.struct("node", "value", "feature", "threshold", "left", "right")
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    forest = trees.agg(F.transform(F.sort_array(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"]).alias("__trees"))
    entries = vector_to_array(vector).alias("__x")

    def step(tree: Column, at: Column) -> Column:
        here = F.get(tree, at)
        side = F.when(F.get(F.col("__x"), here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])
        return F.when(here["feature"].isNull(), at).otherwise(side)

    def leaf(tree: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), lambda at, _: step(tree, at))

    walked = rows.select(key, entries).join(F.broadcast(forest)).withColumn("leaves", F.transform("__trees", leaf))
    values = F.zip_with("__trees", "leaves", lambda tree, at: F.get(tree, at)["value"])
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return walked.select(key, "leaves", (total / F.size("leaves")).alias("prediction"))
