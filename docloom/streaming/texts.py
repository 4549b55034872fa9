"""Rule programs over a stream of text files: each row is on its own, so the batch operator serves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.rules import extract


def stream_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.format("text").option("wholetext", "true").load(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def stream_fields(spark: SparkSession, path: str, script: str) -> DataFrame:
    return extract(stream_texts(spark, path), script)
