"""Fixed column contracts of the page model (declared, never inferred)."""

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("dcn", T.StringType()),
    T.StructField("page", T.DoubleType()),
])

SCORING_PAGE = T.StructType([
    T.StructField("Request", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("dcn", T.StringType()),
    T.StructField("page", T.DoubleType()),
])

STREAMED_PAGE = T.StructType([
    T.StructField("Request", T.StringType()),
    T.StructField("Label_In", T.StringType()),
    T.StructField("ID", T.StringType()),
    T.StructField("Type", T.StringType()),
])

PREDICTION = T.StructType([
    T.StructField("Label", T.StringType()),
    T.StructField("Score", T.FloatType()),
    T.StructField("ElapsedTime", T.LongType()),
])

PREDICTION_COLUMNS = T.StructType([
    T.StructField("pred_label", T.StringType()),
    T.StructField("pred_score", T.DoubleType()),
    T.StructField("pred_elapsed_time", T.DoubleType()),
])

EVENT_MESSAGE = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("to_stage", T.StringType()),
])
