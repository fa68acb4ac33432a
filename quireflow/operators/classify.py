"""Classifiers over hashed text and over vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.functions import chunks, text, vectors
from quireflow.operators import embed, labels, sequences
from quireflow.operators.ranking import global_index
from quireflow.session import stored


# ---- nearest centroid ---------------------------------------------------------------

CLASSES, ROWS = 1024, 4096   # of one block
SCORES_BYTES = 16 << 20      # most that scores of all classes may take as a broadcast matrix


@dataclass(frozen=True)
class CentroidModel:
    """A mean vector per class: the table ``(label, label_id)`` of the class names, and the
    vectors in blocks of ``CLASSES`` classes, rows ``(block, members)``."""

    dictionary: DataFrame
    blocks: DataFrame
    classes: int
    dims: int

    def scores(self, vector: str) -> Column:
        """Negative squared distance to each centroid, as ``array<double>``: for models of few
        classes, whose rows hold a number for each. ``nearest_class`` has no such bound."""
        if self.classes * self.dims * 8 > SCORES_BYTES:
            raise ValueError(f"{self.classes} classes are too many for a score of each; use nearest_class")
        members = [m for row in self.blocks.orderBy("block").collect() for m in row["members"]]
        c = np.asarray([m["mean"] for m in members], dtype="float64")
        norms = (c * c).sum(axis=1)

        def make_predict():
            def predict(batch):
                x = batch.astype("float64")
                return -((x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + norms[None, :])

            return predict

        udf = predict_batch_udf(
            make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=2048,
            input_tensor_shapes=[[c.shape[1]]],
        )
        return udf(vector)


def fit_centroids(df: DataFrame, label: str, vector: str) -> CentroidModel:
    """Mean vector per class; ids follow the order of the class names."""
    means = sequences.pool(df.where(F.col(label).isNotNull()), [label], vector).select(label, "mean")
    placed = stored(global_index(means, label, name="label_id").withColumnRenamed(label, "label"), "centroids")
    size = placed.agg(F.count("*").alias("n"), F.max(F.size("mean")).alias("dims")).first()
    if not size.n:
        raise ValueError("no vectors to fit")
    member = F.struct(F.col("label_id").cast("int").alias("label_id"), "mean")
    blocks = placed.groupBy(F.floor(F.col("label_id") / CLASSES).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("members"))
    dictionary = placed.select("label", F.col("label_id").cast("int").alias("label_id"))
    return CentroidModel(dictionary, stored(blocks, "classes"), size.n, size.dims)


_BEST = [("best", "<i4"), ("peak", "<f8"), ("total", "<f8"), ("own", "<f8")]


def _row_blocks(batches):
    """Rows in blocks of ``ROWS``: their numbers, vectors and own class ids, packed."""
    base, count = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            piece = batch.slice(at, ROWS)
            vectors_ = np.stack(piece.column("vector").to_numpy(zero_copy_only=False)).astype("<f8")
            own = piece.column("own").fill_null(-1).to_numpy().astype("<i4")
            yield pa.RecordBatch.from_arrays([
                pa.array([base + count], pa.int64()), pa.array([piece.column("row").to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([vectors_.tobytes()], pa.binary()), pa.array([own.tobytes()], pa.binary()),
            ], names=["row_block", "rows", "vectors", "own"])
            count += 1


def _compare(dims: int, scale: float):
    """The best class of each row within one block of classes, the sum of exponentials there,
    and the score of the row's own class if it is among them."""
    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                ids = np.array([m["label_id"] for m in row["members"]])
                c = np.array([m["mean"] for m in row["members"]], "<f8")
                x = np.frombuffer(row["vectors"], "<f8").reshape(-1, dims)
                own = np.frombuffer(row["own"], "<i4")
                scores = -((x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)[None, :]) * scale
                out = np.zeros(len(x), _BEST)
                at = scores.argmax(axis=1)
                out["best"], out["peak"] = ids[at], scores[np.arange(len(x)), at]
                out["total"] = np.exp(scores - out["peak"][:, None]).sum(axis=1)
                here = (own >= ids[0]) & (own <= ids[-1])
                out["own"] = np.where(here, scores[np.arange(len(x)), np.where(here, own - ids[0], 0)], np.nan)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["row_block"]], pa.int64()), pa.array([row["rows"]], pa.binary()),
                    pa.array([out.tobytes()], pa.binary())], names=["row_block", "rows", "found"])
    return run


def _best_of_blocks(table: pa.Table) -> pa.Table:
    found = np.stack([np.frombuffer(f, _BEST) for f in table["found"].to_pylist()])
    found = np.take_along_axis(found, np.argsort(found["best"], axis=0), axis=0)  # the first class wins a tie
    at = found["peak"].argmax(axis=0)
    rows = np.arange(found.shape[1])
    peak = found["peak"][at, rows]
    total = (found["total"] * np.exp(found["peak"] - peak)).sum(axis=0)
    own = np.where(np.isnan(found["own"]).all(axis=0), np.nan, np.nan_to_num(found["own"], nan=0.0).sum(axis=0))
    loss = np.log(total) + peak - own
    return pa.table({"_row": np.frombuffer(table["rows"][0].as_py(), "<i8"), "_best": found["best"][at, rows],
                     "probability": 1.0 / total, "loss": pa.array(loss, mask=np.isnan(loss))})


def nearest_class(
    df: DataFrame, model: CentroidModel, vector: str, label: str | None = None, scale: float = 1.0
) -> DataFrame:
    """Add ``predicted`` (class), its ``probability`` (softmax over the scores of all classes)
    and, given the ``label`` column, ``loss``, the cross-entropy.

    For any number of classes: blocks of rows meet blocks of classes, each pair in one matrix
    product that keeps the best class of each row and the sum of exponentials, and the blocks'
    answers are merged. A row without vector has no prediction, one with a null or unseen label
    no loss. The rows themselves do not travel with the vectors; they are stored once and get
    their answers by number.
    """
    held = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    slim = held.where(F.col(vector).isNotNull()).select(
        F.col("_row").alias("row"), F.col(vector).cast("array<double>").alias("vector"),
        (F.lit(None).cast("string") if label is None else F.col(label)).alias("class"))
    ids = model.dictionary.select(F.col("label").alias("_name"), F.col("label_id").cast("int").alias("own"))
    slim = slim.withColumn("own", F.lit(None).cast("int")) if label is None else slim.join(
        ids, F.col("class") == F.col("_name"), "left")
    slim = slim.select("row", "vector", "own")
    packed = slim.mapInArrow(_row_blocks, "row_block long, rows binary, vectors binary, own binary")
    # Few classes are few keys: the rows are dealt over salts, which the classes are copied to.
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = -(-model.classes // CLASSES) - 1
    left = packed.withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.lit(last))), "salt": F.pmod(F.xxhash64("row_block"), F.lit(salts)).cast("int")})
    right = model.blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    compared = left.join(right, ["block", "salt"]).mapInArrow(
        _compare(model.dims, scale), "row_block long, rows binary, found binary")
    best = compared.groupBy("row_block").applyInArrow(
        _best_of_blocks, "_row long, _best int, probability double, loss double")
    named = labels.decode_label(best, model.dictionary, "_best", "predicted")
    extra = ["predicted", "probability"] + ["loss"] * (label is not None)
    return held.join(named.select("_row", *extra), "_row", "left").select(*df.columns, *extra)


def classify_by_centroid(df: DataFrame, model: CentroidModel, vector: str, label: str | None = None) -> DataFrame:
    """Add ``scores``, ``predicted`` (class), ``probabilities`` (softmax of the scores) and,
    given the ``label`` column, ``label_id``."""
    scored = df.withColumn("scores", model.scores(vector))
    ready = vectors.with_softmax(scored, "scores", "probabilities").withColumn("_best", vectors.argmax(F.col("scores")))
    named = labels.decode_label(ready, model.dictionary, "_best", "predicted").drop("_best")
    if label is None:
        return named
    ids = model.dictionary.select(F.col("label").alias("_name"), "label_id")
    return named.join(ids, F.col(label) == F.col("_name"), "left").drop("_name")


# ---- text pages ---------------------------------------------------------------------

@dataclass(frozen=True)
class TextModel:
    """Naive Bayes over hashed words of a page's chunks, with all it takes to apply it. The
    class names are a table ``(label, label_id)``."""

    dictionary: DataFrame
    bayes: NaiveBayesModel
    digits: int
    maxlen: int
    overlap: int
    pooling: str
    noise_phrases: tuple[str, ...] = ()


def page_tokens(
    df: DataFrame, source: str, maxlen: int = 200, overlap: int = 50, pooling: str = "all",
    noise_phrases=(), digits: int | None = None, out: str = "tokens",
) -> DataFrame:
    """The words of all chunks of a page, as cleaned for scoring.

    Counting these equals summing the counts of the chunks: words in overlaps appear once
    per chunk. ``pooling='first'`` looks at the first chunk only. With ``digits`` the words
    are hashed to bucket names before the chunks repeat them. Stays within the row.
    """
    if pooling not in ("all", "first"):
        raise ValueError("pooling must be 'all' or 'first'")
    stride = maxlen - overlap
    found = text.serving_words(F.col(source), noise_phrases)
    df = df.withColumn("_w", embed.buckets(found, digits) if digits else found)
    if pooling == "first":
        return df.withColumn(out, F.slice("_w", 1, maxlen)).drop("_w")
    df = df.withColumn("_n", chunks.chunk_count(F.size("_w"), maxlen, overlap, full_split=True))
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda i: F.slice(F.col("_w"), i * stride + 1, F.lit(maxlen)),
    )
    return df.withColumn(out, F.flatten(windows)).drop("_w", "_n")


def page_counts(
    df: DataFrame, source: str, digits: int = 2, maxlen: int = 200, overlap: int = 50, pooling: str = "all",
    noise_phrases=(), out: str = "features",
) -> DataFrame:
    """Adds the hash bucket counts of a page's chunks. Store them when a fit and a scoring
    both need them: the texts are then read and cleaned once."""
    ready = page_tokens(df, source, maxlen, overlap, pooling, noise_phrases, digits, "_tokens")
    return embed.bucket_counts(ready, "_tokens", digits, out).drop("_tokens")


def fit_text_model(
    pages: DataFrame, source: str | None, label: str = "label", digits: int = 2,
    maxlen: int = 200, overlap: int = 50, pooling: str = "all", noise_phrases=(),
    smoothing: float = 1.0,
) -> TextModel:
    """Fit on texts, or (``source`` None) on stored ``features``."""
    if source is not None:
        pages = page_counts(pages.select(label, source), source, digits, maxlen, overlap, pooling, noise_phrases)
    dictionary = stored(labels.label_index(pages, label).drop("rows"), "classes")
    ready = labels.attach_label_id(pages.select("features", label), dictionary, label, "_y")
    bayes = NaiveBayes(
        modelType="multinomial", smoothing=smoothing, featuresCol="features", labelCol="_y",
        predictionCol="prediction", probabilityCol="probability", rawPredictionCol="raw",
    ).fit(ready)
    return TextModel(dictionary, bayes, digits, maxlen, overlap, pooling, tuple(noise_phrases))


def apply_text_model(pages: DataFrame, model: TextModel, source: str | None) -> DataFrame:
    """Add ``class`` and ``score`` (its probability) to every page, in the JVM. Only the
    class ids meet the table of names."""
    if source is not None:
        pages = page_counts(pages, source, model.digits, model.maxlen, model.overlap, model.pooling, model.noise_phrases)
    scored = (
        model.bayes.transform(pages)
        .withColumn("_best", F.col("prediction").cast("int"))
        .withColumn("score", F.array_max(vector_to_array("probability")))
        .drop("features", "raw", "probability", "prediction")
    )
    return labels.decode_label(scored, model.dictionary, "_best", "class").drop("_best")


# ---- linear classifier --------------------------------------------------------------

GROUPS = 32  # of tasks whose gradients are added up together


@dataclass(frozen=True)
class LinearModel:
    """Weights ``[classes, dimensions + 1]`` (the last is the intercept) and the metric rows
    ``(epoch, split, rows, hits, loss)`` seen while fitting."""

    weights: np.ndarray
    history: list[tuple[int, str, int, int, float]]


def _pass_over(vector: str, label_id: str, split: str, weights: np.ndarray):
    """Sums over a task's rows: per split the rows, hits and loss, and the gradient of the
    training rows."""
    def run(batches):
        import pandas as pd

        seen: dict[str, list[float]] = {}
        grad = np.zeros_like(weights)
        for batch in batches:
            if not len(batch):
                continue
            x = np.vstack(batch[vector].to_numpy()).astype("float64")
            x = np.hstack([x, np.ones((len(x), 1))])
            y = batch[label_id].to_numpy().astype(int)
            raw = x @ weights.T
            raw -= raw.max(axis=1, keepdims=True)
            p = np.exp(raw)
            p /= p.sum(axis=1, keepdims=True)
            at = np.arange(len(y))
            loss, hit = -np.log(p[at, y]), raw.argmax(axis=1) == y
            p[at, y] -= 1.0
            train = (batch[split] == "train").to_numpy()
            grad += p[train].T @ x[train]
            for name in batch[split].unique():
                mine = (batch[split] == name).to_numpy()
                sums = seen.setdefault(name, [0, 0, 0.0])
                sums[0] += int(mine.sum())
                sums[1] += int(hit[mine].sum())
                sums[2] += float(loss[mine].sum())
        yield pd.DataFrame({
            "split": [*seen, None], "sums": [*[np.array(v, float) for v in seen.values()], grad.ravel()]})
    return run


def fit_linear(
    df: DataFrame, vector: str, label_id: str, classes: int, epochs: int = 5, rate: float = 1.0,
    split: str = "split",
) -> LinearModel:
    """Softmax regression by full-batch gradient steps on the rows of the ``train`` split.

    One pass per epoch: each task sends its gradient and the sums behind the metrics of
    every split as vectors, which are added up in two levels; the driver gets the totals. Store ``df`` first. The last history
    rows are those of the final weights.
    """
    first = df.select(F.size(vector).alias("d")).first()
    if first is None:
        raise ValueError("no rows to fit")
    weights, history = np.zeros((classes, first["d"] + 1)), []
    slim = df.select(vector, label_id, split)
    for epoch in range(epochs + 1):
        parts = slim.mapInPandas(_pass_over(vector, label_id, split, weights), "split string, sums array<double>")
        # Whole vectors are summed, first within groups of tasks and then over these.
        partly = parts.select("split", array_to_vector("sums").alias("v"), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
        partly = partly.groupBy("split", "g").agg(Summarizer.sum(F.col("v")).alias("v"))
        sums = {r["split"]: r["v"].toArray() for r in
                partly.groupBy("split").agg(Summarizer.sum(F.col("v")).alias("v")).collect()}  # a row per split, and one
        grad = sums.pop(None)
        for name, s in sorted(sums.items()):
            history.append((epoch, name, int(s[0]), int(s[1]), s[2] / s[0]))
        if epoch < epochs and "train" in sums:
            weights = weights - rate * grad.reshape(weights.shape) / sums["train"][0]
    return LinearModel(weights, history)


def linear_metrics(spark: SparkSession, model: LinearModel, run_id: str) -> DataFrame:
    """The fit's metrics as rows ``(run_id, step, split, metric, value)``."""
    rows = [(run_id, epoch, split, metric, value) for epoch, split, n, hits, loss in model.history
            for metric, value in (("loss", float(loss)), ("acc", hits / n))]
    return spark.createDataFrame(rows, "run_id string, step int, split string, metric string, value double")


def linear_scores(df: DataFrame, model: LinearModel, vector: str) -> DataFrame:
    """Add ``scores`` and ``prediction`` (class id)."""
    w = model.weights

    def make_predict():
        def predict(batch):
            return batch.astype("float64") @ w[:, :-1].T + w[:, -1]
        return predict

    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=2048,
                            input_tensor_shapes=[[w.shape[1] - 1]])
    return df.withColumn("scores", udf(vector)).withColumn("prediction", vectors.argmax(F.col("scores")))
