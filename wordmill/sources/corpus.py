"""Corpus readers: Parquet and JSON tables, whole text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, path: str, fmt: str | None = None, key: str = "doc_id") -> DataFrame:
    """One row per sequence.  Parquet keeps its own key; text files are read
    whole (one row per file) and keyed by a stable hash of the path."""
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "text")
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.json(path)
    df = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    return df.select(F.xxhash64("path").alias(key), "path", F.col("value").alias("text"))
