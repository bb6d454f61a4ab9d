"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, scratch_path, ship_package

# A word of the contracts that split on ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*cols)


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the key as text, modulo m; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(m)


def row_key(df: DataFrame) -> list[Column]:
    """Two columns that identify a row by content, null-safe: rows with the
    same key are equal in every column, so they may share one result. The first
    orders by doc_id, nulls last."""
    first = F.col("doc_id") if "doc_id" in df.columns else F.lit(0)
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [
        F.coalesce(first.cast("bigint"), F.lit(2**63 - 1)).alias("__wm_d"),
        F.xxhash64(*[F.struct(c.isNull(), c) for c in cols]).alias("__wm_t"),
    ]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, which cuts its lineage and
    takes less room than a checkpoint."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def map_text(
    df: DataFrame,
    fn: Callable[..., dict[str, pa.Array]],
    schema: str,
    drop: tuple[str, ...] = (),
    with_batch: bool = False,
) -> DataFrame:
    """Append the columns of ``schema`` that ``fn`` computes from each batch of
    the ``text`` column (UTF-8 bytes, None for null), dropping ``drop``. With
    ``with_batch``, ``fn`` also gets the Arrow batch."""
    ship_package(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name not in drop]
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [schema])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # A few hundred rows at a time bound the arrays built from the texts.
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                new = fn(texts, batch) if with_batch else fn(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names] + list(new.values()), names=names + list(new)
                )

    return df.mapInArrow(run, out)
