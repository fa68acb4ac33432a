"""CSV pages in and out. Read and write options mirror each other, so quotes, commas and
line breaks inside a field survive the round trip.

A multi-line CSV file cannot be split: a scan has as many tasks as files. Land large
inputs to Parquet once (``tables.save_table``) and work from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.operators.prepare import drop_stray_headers

_READ = {"multiLine": "true", "escape": '"'}
_WRITE = {
    "lineSep": "\n", "escape": '"', "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_options(header: bool, line_sep: str | None = "\n") -> dict[str, str]:
    """Reader options, the same for batch and stream. Without a given line end the parser
    guesses it from the first it meets, which may be one inside a quoted text; pass
    ``None`` only for files from elsewhere whose line end is not known."""
    sep = {"lineSep": line_sep} if line_sep else {}
    return {**_READ, **sep, "header": str(header).lower()}


def read_pages(
    spark: SparkSession, path, schema: T.StructType, header: bool = False, line_sep: str | None = "\n"
) -> DataFrame:
    return spark.read.schema(schema).options(**read_options(header, line_sep)).format("csv").load(path)


def write_pages(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Empty text is written quoted, so it stays apart from null (an empty field)."""
    df.write.mode(mode).options(**_WRITE, header=str(header).lower()).csv(path)


def sample_files(
    spark: SparkSession, paths: list[str], out: str, schema: T.StructType, rows: int = 50,
    column: str = "Request",
) -> DataFrame:
    """The first ``rows`` rows of every input file, written to one folder per file.

    One job for all files: a per-file row number in reading order, which Spark limits
    before the exchange. A folder is named by the last two steps of its file's path and a
    digest of the whole path, so files of equal names in different folders stay apart.
    Returns the sampled rows with their ``file``.
    """
    pages = drop_stray_headers(read_pages(spark, paths, schema, header=True), column)
    pages = pages.withColumns({"_path": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    place = F.row_number().over(Window.partitionBy("_path").orderBy("_at"))
    sampled = (
        pages.withColumn("_n", place).where(F.col("_n") <= rows)
        .withColumn("file", F.concat_ws(
            "-", F.regexp_replace(F.substring_index("_path", "/", -2), "[^A-Za-z0-9.]+", "_"),
            F.substring(F.md5("_path"), 1, 12)))
        .drop("_n", "_at", "_path")
    )
    sampled.write.mode("overwrite").partitionBy("file").options(**_WRITE, header="true").csv(out)
    with_file = T.StructType([*schema.fields, T.StructField("file", T.StringType())])
    return read_pages(spark, out, with_file, header=True)
