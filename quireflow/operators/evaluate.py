"""Classifier and regressor evaluation.

Everything about classes starts from ``confusion``: one map-side combined count that
turns any number of predictions into at most classes² small rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(actual, predicted, rows)``."""
    return df.groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count("*").alias("rows"))


def confusion_wide(pairs: DataFrame, classes: list) -> DataFrame:
    """One row per predicted class, one column per actual class; 0 where none. Fails if a
    pair has an actual class outside the list, so no row can go missing."""
    known = F.col("actual").isin(classes)
    checked = pairs.withColumn("actual", F.when(known, F.col("actual")).otherwise(
        F.raise_error(F.concat(F.lit("class outside the list: "), F.coalesce(F.col("actual").cast("string"), F.lit("null"))))))
    return checked.groupBy("predicted").pivot("actual", classes).agg(F.sum("rows")).na.fill(0)


def confusion_share(pairs: DataFrame) -> DataFrame:
    """Each cell as a share of its actual class."""
    total = F.sum("rows").over(Window.partitionBy("actual"))
    return pairs.withColumn("share", F.col("rows") / total)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def class_report(pairs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class and three summary rows.

    ``classes`` (one column ``cls``) is the full class list; classes without any row are
    listed with zeros. When one of them never occurs the accuracy row is named
    ``micro avg``. The accuracy row carries the accuracy in every column, support
    included, which is how the usual report frame shows a single number.
    """
    n = F.col("rows")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(F.lit(0))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("actual").cast("string").alias("cls"), n.alias("support"),
                 F.lit(0).cast("bigint").alias("guessed"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("predicted").cast("string").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 n.alias("guessed"), F.lit(0).cast("bigint").alias("hits")),
    )).alias("s")).select("s.*")
    if classes is not None:
        zero = F.lit(0).cast("bigint")
        sides = sides.unionByName(classes.select(
            F.col("cls").cast("string").alias("cls"), zero.alias("support"),
            zero.alias("guessed"), zero.alias("hits"),
        ))
    per_class = (
        sides.groupBy("cls")
        .agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
             F.sum("hits").alias("hits"))
        .withColumn("precision", _ratio(F.col("hits"), F.col("guessed")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(
            2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
        ))
    )
    # Each class feeds its own row and the three summary rows, so the predictions behind
    # it are read once.
    parts = ["precision", "recall", "f1"]
    zero = F.lit(0).cast("bigint")

    def feed(kind: int, name: Column, weight: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.alias("cls"),
            *[(F.col(p) * weight).alias(p) for p in parts],
            F.col("support").alias("support"), F.col("hits").alias("hits"),
            (F.col("support") + F.col("guessed")).alias("seen"),
        )

    fed = per_class.select(F.explode(F.array(
        feed(0, F.col("cls"), F.lit(1.0)),
        feed(1, F.lit("accuracy"), F.lit(0.0)),
        feed(2, F.lit("macro avg"), F.lit(1.0)),
        feed(3, F.lit("weighted avg"), F.col("support").cast("double")),
    )).alias("r")).select("r.*")
    rows = fed.groupBy("kind", "cls").agg(
        *[F.sum(p).alias(p) for p in parts], F.sum("support").alias("support"),
        F.sum("hits").alias("hits"), F.min("seen").alias("seen"), F.count("*").alias("n"),
    )
    kind, support = F.col("kind"), F.col("support").cast("double")
    acc = _ratio(F.col("hits"), F.col("support"))
    is_acc, everyone = kind == 1, F.col("seen") > zero
    return rows.select(
        F.when(is_acc & ~everyone, "micro avg").otherwise(F.col("cls")).alias("cls"),
        *[
            F.when(is_acc, acc).when(kind == 2, F.col(p) / F.col("n"))
            .when(kind == 3, _ratio(F.col(p), support)).otherwise(F.col(p)).alias(p)
            for p in parts
        ],
        F.when(is_acc & everyone, acc).otherwise(support).alias("support"),
    )


def accuracy(actual: str, predicted: str) -> Column:
    return F.avg((F.col(actual) == F.col(predicted)).cast("double"))


def cross_entropy(scores: str, class_id: str) -> Column:
    """Loss of a row from its class scores (logits) and true class (0-based id): the log of
    the summed exponentials less the true score. Finite also where the probability of the
    true class is too small for a number."""
    top = F.array_max(scores)
    total = F.aggregate(F.transform(scores, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return F.log(total) + top - F.get(F.col(scores), F.col(class_id).cast("int"))


def accuracy_and_loss(
    df: DataFrame, actual: str, predicted: str, loss: str, batch: str | None = None, by: tuple = ()
) -> DataFrame:
    """Accuracy and mean loss; with ``batch`` the loss is the mean of batch means."""
    if batch is None:
        return df.groupBy(*by).agg(
            accuracy(actual, predicted).alias("acc"), F.avg(loss).alias("loss")
        )
    per_batch = df.groupBy(*by, batch).agg(
        F.sum((F.col(actual) == F.col(predicted)).cast("bigint")).alias("_hits"),
        F.count("*").alias("_rows"), F.avg(loss).alias("_loss"),
    )
    return per_batch.groupBy(*by).agg(
        (F.sum("_hits") / F.sum("_rows")).alias("acc"), F.avg("_loss").alias("loss")
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: str) -> DataFrame:
    """``mse, rmse, mae, r2`` per split over its complete pairs, in one pass.

    ``rows`` counts these pairs and ``incomplete`` the others; ``r2`` is null for a constant
    target, and all metrics are null without a pair.
    """
    whole = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    target = F.when(whole, F.col(actual))
    err = target - F.col(predicted)
    n, sse = F.count(err), F.sum(err * err)
    return df.groupBy(by).agg(
        n.alias("rows"),
        F.count(F.when(~whole, 1)).alias("incomplete"),
        F.try_divide(sse, n).alias("mse"),
        F.sqrt(F.try_divide(sse, n)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(sse, n * F.var_pop(target))).alias("r2"),
    )
