"""Chunk embeddings: hashed bags of words inside the JVM, or a model of the caller's."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.functions.hashing import text_key
from quireflow.session import stored
from quireflow.sources import feature_store


def bucket_names(digits: int) -> list[str]:
    """All hex strings of that length, i.e. the vocabulary of hash buckets."""
    return [format(i, f"0{digits}x") for i in range(16**digits)]


def buckets(tokens: Column, digits: int) -> Column:
    """Bucket name of each token: the first digits of its md5, which any engine can repeat."""
    return F.transform(tokens, lambda t: F.substring(F.md5(t), 1, digits))


def bucket_counts(df: DataFrame, names: str, digits: int, out: str) -> DataFrame:
    """How often each bucket occurs in an array of bucket names, as a sparse vector."""
    counter = CountVectorizerModel.from_vocabulary(
        bucket_names(digits), inputCol=names, outputCol=out, minTF=1.0
    )
    return counter.transform(df)


def hashed_counts(df: DataFrame, tokens: Column, digits: int = 2, out: str = "features") -> DataFrame:
    """Token counts per hash bucket as a vector of ``16 ** digits`` entries.

    Row-local and linear in the number of tokens.
    """
    named = df.withColumn("_buckets", buckets(tokens, digits))
    return bucket_counts(named, "_buckets", digits, out).drop("_buckets")


def hashed_embedding(df: DataFrame, tokens: Column, digits: int = 2, out: str = "embedding") -> DataFrame:
    """Unit-length hashed bag of words as ``array<float>``; all zero for no tokens."""
    counted = hashed_counts(df, tokens, digits, out="_counts")
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
    return unit.withColumn(out, vector_to_array("_unit", dtype="float32")).drop("_counts", "_unit")


def model_embedding(
    make_predict: Callable[[], Callable], *inputs: str,
    batch_size: int = 64, input_shapes: Sequence[Sequence[int] | None] | None = None,
) -> Column:
    """Embedding by a model that each Python worker loads once.

    ``make_predict`` returns a function from numpy batches to a two-dimensional array.
    """
    udf = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=input_shapes,
    )
    return udf(*inputs)


def cached_embedding(
    df: DataFrame, source: str, embedding: Column, table: str, model: str, out: str = "embedding", buckets: int = 16,
) -> DataFrame:
    """Add ``embedding``, computed only for texts that no earlier run has embedded.

    ``table`` is a feature table of vectors by model name and digest of the text; it is made on
    first use. Texts it lacks reach the model once each, however often they occur, and join it;
    a second run over the same texts calls no model. Rows of null text get null.
    """
    spark = df.sparkSession
    keyed = df.withColumns({"_model": F.lit(model), "_digest": text_key(F.col(source))})
    missing = keyed.where(F.col("_digest").isNotNull()).select("_model", "_digest", F.col(source))
    known = spark.catalog.tableExists(f"{table}__files")
    if known:
        missing = missing.join(spark.table(table).select("_model", "_digest"), ["_model", "_digest"], "left_anti")
    missing = stored(missing.dropDuplicates(["_model", "_digest"]), "missing")
    made = missing.select("_model", "_digest", embedding.alias("_vector"))
    if not known:
        feature_store.create_feature_table(made, table, ["_model", "_digest"], buckets)
    elif not missing.isEmpty():
        feature_store.merge_features(made, table)
    vectors = spark.table(table).where(F.col("_model") == model).select("_digest", F.col("_vector").alias(out))
    return keyed.join(vectors, "_digest", "left").select(*df.columns, out)
