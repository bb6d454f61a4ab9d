"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet to the shared folder and read again as the next stage's docs:

1. quality_rules: documents that the rules reject go.
2. line_dedup: runs of lines that repeat an earlier place go from the texts.
3. simhash_near_dedup: one document of each group of near copies stays.
4. benchmark_decontamination: passages of benchmark items go from the texts.
5. source_mix: documents chosen to source targets, with the words taken.

All but the last return the columns of their input. Nulls, empty texts, repeated
rows and extra columns follow each operator's docstring; an empty table passes
through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm.decontam import decontaminate
from wordmill.llm.lines import without_repeats
from wordmill.llm.mixing import select_mix
from wordmill.llm.quality import keep_good
from wordmill.llm.simhash import keep_one
from wordmill.session import read_table, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return select_mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

# XXH64 and the automaton's spans have no counterpart in DuckDB; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
