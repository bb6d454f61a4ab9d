"""Persisting vocabularies and model parameters as Parquet tables."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gradients import adam_state
from ..operators.params import PARAMS_SCHEMA, ModelShape, init_params, model_meta, param_specs
from ..operators.vocab import VOCAB_SCHEMA


def write_vocab(vocab: DataFrame, path: str, fmt: str = "parquet") -> str:
    vocab.select("token", "id", "n", "first_doc", "first_pos").write.mode("overwrite").format(fmt).save(path)
    return path


def read_vocab(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(VOCAB_SCHEMA).load(path)


def write_state(state: DataFrame, path: str, shape: ModelShape | None = None, step: int = 0) -> str:
    """A parameter table (param, row_id, vec, and the moments m and v when
    present) partitioned by parameter name, plus a one-row meta table with the
    steps taken and, for a model, its dimensions."""
    state.write.mode("overwrite").partitionBy("param").parquet(f"{path}/weights")
    model_meta(state.sparkSession, shape, step).write.mode("overwrite").parquet(f"{path}/meta")
    return path


def write_params(state: DataFrame, shape: ModelShape, path: str, step: int = 0) -> str:
    """write_state of a model."""
    return write_state(state, path, shape, step)


def read_state(spark: SparkSession, path: str, initial: DataFrame) -> DataFrame:
    """Load a parameter table over initial values: unknown names are ignored; a
    name that is absent, or whose rows are not those of ``initial`` in number and
    summed length, keeps its initial values.  The moments are loaded with the
    weights where both sides have them."""
    saved = spark.read.parquet(f"{path}/weights")
    cols = [c for c in ("vec", "m", "v") if c in initial.columns and c in saved.columns]
    size = lambda df: df.groupBy("param").agg(F.count("*").alias("_rows"), F.sum(F.size("vec")).alias("_cells"))
    valid = size(saved).join(size(initial), ["param", "_rows", "_cells"]).select("param")
    loaded = saved.join(valid, "param", "left_semi").select("param", "row_id", *[F.col(c).alias(f"_{c}") for c in cols])
    out = initial.join(loaded, ["param", "row_id"], "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in initial.columns])


def read_params(spark: SparkSession, path: str, shape: ModelShape, initial: DataFrame) -> DataFrame:
    """Weights of a model of the given shape over initial ones; a name whose
    element count is not rows x cols keeps its initial value."""
    return read_state(spark, path, initial.where(F.col("param").isin([n for n, *_ in param_specs(shape)])))


def load_model(spark: SparkSession, path: str, seed: int = 0) -> tuple[DataFrame, ModelShape, int]:
    """(state, shape, steps) of a model folder that write_params made: the
    dimensions come from its meta table, the moments too if they were saved
    (zeros otherwise), so training can go on where it stopped.  A tensor that is
    missing or misshapen has fresh values."""
    meta = spark.read.parquet(f"{path}/meta").first().asDict()
    sizes = {f.name for f in fields(ModelShape)}
    shape = ModelShape(**{k: v for k, v in meta.items() if k in sizes and v is not None})
    fresh = adam_state(init_params(spark, shape, seed))
    return read_state(spark, path, fresh), shape, meta["step"]


__all__ = [
    "PARAMS_SCHEMA",
    "load_model",
    "read_params",
    "read_state",
    "read_vocab",
    "write_params",
    "write_state",
    "write_vocab",
]
