"""Line pipelines over streams. The line operators are expressions, so a stream runs the same plan as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def clean_stream(stream: DataFrame, operator: Callable[[Column], Column], value: str = "value") -> DataFrame:
    """Kept lines of a stream: original and value."""
    return stream.withColumn("original", F.col(value)).withColumn(value, operator(F.col(value))).where(F.col(value).isNotNull())


def text_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def reloading(stream: DataFrame, load_rules: Callable[[], list[tuple]], build: Callable[[list[tuple]], Callable[[Column], Column]], write: Callable[[DataFrame, int], None], value: str = "value"):
    """A ``foreachBatch`` writer that loads the dictionary anew for every micro-batch, the counterpart of a timed reload."""

    def batch(df: DataFrame, epoch: int) -> None:
        write(df.withColumn(value, build(load_rules())(F.col(value))), epoch)

    return stream.writeStream.foreachBatch(batch)


def word_counts_by_window(stream: DataFrame, ts: str = "ts", value: str = "value", size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """window, word, freq with a watermark for late rows."""
    from lexmill.functions.regex import tokens

    return stream.withWatermark(ts, late).select(ts, F.explode(tokens(F.col(value))).alias("word")).groupBy(F.window(ts, size), "word").agg(F.count("*").alias("freq"))
