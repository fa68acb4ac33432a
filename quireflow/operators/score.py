"""Scoring pages: in the JVM, by partition, or as a column function."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.contracts import PREDICTION
from quireflow.operators.classify import TextModel, apply_text_model
from quireflow.operators.labels import decode_label

SCORED = T.StructType([
    T.StructField("class_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("elapsed_us", T.LongType()),
])


def score_pages(pages: DataFrame, model: TextModel, source: str | None = "Request") -> DataFrame:
    """Every page with ``pred_label`` (upper case) and ``pred_score``; works on streams too."""
    return (
        apply_text_model(pages, model, source)
        .withColumn("pred_label", F.upper("class"))
        .withColumnRenamed("score", "pred_score")
        .drop("class")
    )


def count_predictor(model: TextModel) -> Callable[[], Callable]:
    """A loader for the Python routes: builds the model once per worker.

    The loaded function maps a batch of count vectors to class ids and probabilities by one
    matrix product. It carries two arrays, so workers need no package of ours.
    """
    log_prior = model.bayes.pi.toArray()
    log_weight = model.bayes.theta.toArray().T.copy()

    def load():
        import numpy as np

        def predict(counts):
            raw = counts.astype("float64") @ log_weight + log_prior
            e = np.exp(raw - raw.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            return best, p[np.arange(len(best)), best]

        return predict

    return load


def count_arrays(features: DataFrame, out: str = "counts") -> DataFrame:
    """Count vectors as arrays, which is what a Python predictor reads."""
    return features.withColumn(out, vector_to_array("features", dtype="float32")).drop("features")


def with_names(df: DataFrame, model: TextModel, ids: str, out: str) -> DataFrame:
    """Upper-case class names for predicted ids."""
    return decode_label(df, model.dictionary, ids, out).withColumn(out, F.upper(out)).drop(ids)


def score_by_partition(
    df: DataFrame, keys: Sequence[str], source: str, load: Callable[[], Callable]
) -> DataFrame:
    """``mapInPandas`` scoring: the key and ``class_id, Score, ElapsedTime`` for every row.

    The model loads once per task and sees whole Arrow batches. ``ElapsedTime`` is a row's
    share of its batch's time in microseconds, rounded up.
    """
    keys = list(keys)
    narrow = df.select(*keys, source)
    schema = T.StructType([narrow.schema[k] for k in keys] + [
        T.StructField("class_id", T.IntegerType()), *PREDICTION.fields[1:]])

    def run(batches):
        import time

        import numpy as np

        predict = load()
        for batch in batches:
            start = time.perf_counter()
            if not len(batch):
                continue
            ids, scores = predict(np.vstack(batch[source].to_numpy()))
            spent = (time.perf_counter() - start) * 1e6 / len(batch)
            out = batch[keys].copy()
            out["class_id"], out["Score"], out["ElapsedTime"] = ids.astype("int32"), scores.astype("float32"), int(spent) + 1
            yield out

    return narrow.mapInPandas(run, schema)


def score_column(source: str, load: Callable[[], Callable], width: int, batch_size: int = 2048) -> Column:
    """Model as a column function returning ``struct<class_id, score, elapsed_us>``."""

    def make_predict():
        import time

        import numpy as np

        predict = load()

        def run(counts):
            start = time.perf_counter()
            ids, scores = predict(counts)
            spent = int((time.perf_counter() - start) * 1e6 / max(len(ids), 1)) + 1
            return {"class_id": ids.astype("int32"), "score": scores, "elapsed_us": np.full(len(ids), spent, "int64")}

        return run

    return predict_batch_udf(
        make_predict, return_type=SCORED, batch_size=batch_size, input_tensor_shapes=[[width]])(source)


def unpack_struct(df: DataFrame, column: str = "predictions") -> DataFrame:
    """``class_id, pred_score, pred_elapsed_time`` (microseconds) from a struct column."""
    return df.select(
        *[c for c in df.columns if c != column],
        F.col(f"{column}.class_id").alias("class_id"), F.col(f"{column}.score").alias("pred_score"),
        F.col(f"{column}.elapsed_us").cast("double").alias("pred_elapsed_time"),
    )


def as_strings(label: str, score: str, elapsed: str) -> Column:
    """The compatible shape: label, score and time as an array of strings."""
    return F.array(*[F.col(c).cast("string") for c in (label, score, elapsed)])


def unpack_strings(df: DataFrame, column: str = "predictions") -> DataFrame:
    """Read such an array by position into the three prediction columns."""
    names = ["pred_label", "pred_score", "pred_elapsed_time"]
    return df.withColumns({n: F.get(column, F.lit(i)) for i, n in enumerate(names)}).drop(column)
