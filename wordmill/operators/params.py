"""Model parameters as a table.

``params(param STRING, row_id BIGINT, vec ARRAY<DOUBLE>)``: one row per
matrix row.  The output layer is stored transposed (one row per token id,
length D) so that it, the embedding, their gradients and optimiser state all
share the key (param, row_id) and partition alike.  Initial values are pure
functions of (seed, param, row, column), so a job on any number of
executors builds the same model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.random import hash_symmetric, hash_uniform_rows
from ..session import ship_package

PARAMS_SCHEMA = "param string, row_id bigint, vec array<double>"
V_SIZED = ("embedding", "output_layer")
HASHED_BYTES = 55  # a message of one MD5 block
SMALL_PARAM_CELLS = 1 << 16  # parameters below this many cells are built in one task


@dataclass(frozen=True)
class ModelShape:
    vocab_size: int
    embed_size: int = 128
    hidden_size: int = 256
    num_layers: int = 3
    # Fixed values of the reference's model constructor.
    max_seq_len: int = 512
    num_heads: int = 4
    eps: float = 1e-6
    dropout: float = 0.1

    def __post_init__(self):
        if self.embed_size % self.num_heads != 0:
            raise ValueError(f"{self.num_heads} heads cannot share {self.embed_size} dimensions evenly")

    @property
    def head_size(self) -> int:
        return self.embed_size // self.num_heads


def param_specs(shape: ModelShape) -> list[tuple[str, int, int, str]]:
    """(name, stored rows, stored cols, init).  Names follow the checkpoint
    names of the reference; output_layer is stored as V rows of D."""
    V, D, H = shape.vocab_size, shape.embed_size, shape.hidden_size
    specs = [("embedding", V, D, "xavier"), ("positional_encoding", shape.max_seq_len, D, "sincos")]
    for layer in range(shape.num_layers):
        p = f"transformer_{layer}"
        specs += [
            (f"{p}_attn_query", D, D, "xavier"),
            (f"{p}_attn_key", D, D, "xavier"),
            (f"{p}_attn_value", D, D, "xavier"),
            (f"{p}_attn_output", D, D, "xavier"),
            (f"{p}_ff_w1", D, H, "xavier"),
            (f"{p}_ff_w2", H, D, "xavier"),
            (f"{p}_ff_b1", 1, H, "random"),
            (f"{p}_ff_b2", 1, D, "random"),
            (f"{p}_ln1_gamma", 1, D, "ones"),
            (f"{p}_ln1_beta", 1, D, "zeros"),
            (f"{p}_ln2_gamma", 1, D, "ones"),
            (f"{p}_ln2_beta", 1, D, "zeros"),
        ]
    specs += [("final_ln_gamma", 1, D, "ones"), ("final_ln_beta", 1, D, "zeros"), ("output_layer", V, D, "xavier")]
    return specs


def _cell(kind: str, seed: int, name: str, rows: int, cols: int, row: Column, j: Column, d: int) -> Column:
    if kind == "xavier":
        return hash_symmetric(seed, name, row, j) * F.lit(math.sqrt(6.0 / float(rows + cols)))
    if kind == "random":
        return hash_symmetric(seed, name, row, j)
    if kind == "ones":
        return F.lit(1.0)
    if kind == "zeros":
        return F.lit(0.0)
    if kind == "sincos":
        even = j - j % 2
        angle = row.cast("double") / F.pow(F.lit(10000.0), even.cast("double") / F.lit(float(d)))
        return F.when(j % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))
    raise ValueError(kind)


def _cell_fn(kind, seed, name, rows, cols, row, d):
    return lambda j: _cell(kind, seed, name, rows, cols, row, j, d)


def init_params(spark: SparkSession, shape: ModelShape, seed: int = 0) -> DataFrame:
    """Fresh weights: Xavier for embedding, attention, W1/W2 and output;
    uniform [-1, 1) biases; gamma 1, beta 0; sinusoidal positions.  Rows are
    generated by ``range`` (distributed), columns by an array transform, or, for
    the V-sized parameters, by hashing many cells side by side (the same numbers)."""
    frames = []
    for name, rows, cols, kind in param_specs(shape):
        r, c = (rows, cols)
        if name == "output_layer":
            r, c = shape.embed_size, shape.vocab_size  # Xavier limit of the D x V matrix
        if name in V_SIZED and len(f"{seed}:{name}:{rows}:{cols}") <= HASHED_BYTES:
            frames.append(_hashed_rows(spark, name, rows, cols, seed, math.sqrt(6.0 / float(r + c))))
            continue
        row = F.col("id")
        vec = F.transform(F.sequence(F.lit(0), F.lit(cols - 1)), _cell_fn(kind, seed, name, r, c, row, shape.embed_size))
        parts = None if rows * cols > SMALL_PARAM_CELLS else 1
        frames.append(spark.range(0, rows, 1, parts).select(F.lit(name).alias("param"), F.col("id").alias("row_id"), vec.alias("vec")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _hashed_rows(spark: SparkSession, name: str, rows: int, cols: int, seed: int, limit: float) -> DataFrame:
    """The rows of a Xavier parameter, as ``_cell`` defines them."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            vec = (hash_uniform_rows(seed, name, ids.to_numpy(), cols) * 2.0 - 1.0) * limit
            ends = pa.array(np.arange(0, (len(ids) + 1) * cols, cols, dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(vec.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids), pa.string()), ids, lists], ["param", "row_id", "vec"])

    ship_package(spark)
    parts = None if rows * cols > SMALL_PARAM_CELLS else 1
    return spark.range(0, rows, 1, parts).mapInArrow(fill, PARAMS_SCHEMA)


def model_meta(spark: SparkSession, shape: ModelShape | None, step: int = 0) -> DataFrame:
    """One row: the steps taken, and the fields of the shape (null without one)."""
    names = [(f.name, "double" if f.type == "float" else "bigint") for f in fields(ModelShape)]
    row = tuple(getattr(shape, n) if shape else None for n, _ in names)
    return spark.createDataFrame([(*row, step)], ", ".join(f"{n} {t}" for n, t in names) + ", step bigint")


def core_specs(shape: ModelShape) -> list[tuple[str, int, int, str]]:
    """The parameters whose size does not depend on the vocabulary."""
    return [spec for spec in param_specs(shape) if spec[0] not in V_SIZED]


def collect_rows(params: DataFrame, specs: list[tuple[str, int, int, str]]) -> dict[str, np.ndarray]:
    """Dense numpy tensors of the named parameters, on the driver.

    Absent rows keep zeros; vectors of the wrong length are ignored."""
    out = {name: np.zeros((rows, cols)) for name, rows, cols, _ in specs}
    tbl = params.select("param", "row_id", "vec").toArrow()
    names = np.asarray(tbl.column("param").to_pylist(), dtype=object)
    rid = tbl.column("row_id").to_numpy()
    vec = tbl.column("vec").combine_chunks()
    offsets = vec.offsets.to_numpy()
    lens = np.diff(offsets)
    flat = vec.values.to_numpy(zero_copy_only=False)
    for name in np.unique(names):
        if name not in out:
            continue
        m = out[name]
        r, c = m.shape
        idx = np.nonzero(names == name)[0]
        ok = idx[(lens[idx] == c) & (rid[idx] >= 0) & (rid[idx] < r) & ~np.asarray(vec.is_null().to_numpy(zero_copy_only=False))[idx]]
        if len(ok):
            m[rid[ok]] = flat[offsets[ok][:, None] + np.arange(c)[None, :]]
    return out


def collect_weights(params: DataFrame, shape: ModelShape) -> dict[str, np.ndarray]:
    """A whole model on the driver, to look at a small one. No job calls it."""
    return collect_rows(params, param_specs(shape))


def named_rows(params: DataFrame, vocab: DataFrame) -> DataFrame:
    """(param, row_id, token, vec): V-sized rows with the word they belong to."""
    words = vocab.select(F.col("id").alias("row_id"), "token")
    sized = F.col("param").isin(*V_SIZED)
    v = params.where(sized).join(words, "row_id", "left").select("param", "row_id", "token", "vec")
    rest = params.where(~sized).select("param", "row_id", F.lit(None).cast("string").alias("token"), "vec")
    return v.unionByName(rest)


def flatten_all(params: DataFrame) -> DataFrame:
    """Row-major flat lists of every parameter: (param, k, v) with k = row_id x
    columns + column, in the stored layout (output_layer has V rows of D)."""
    cells = params.select("param", "row_id", F.size("vec").alias("_c"), F.posexplode("vec").alias("_j", "v"))
    return cells.select("param", (F.col("row_id") * F.col("_c") + F.col("_j")).alias("k"), "v")


def unflatten_all(flat: DataFrame, shapes: DataFrame) -> DataFrame:
    """(param, k, v) and shapes(param, rows, cols) -> (param, row_id, vec).  A
    parameter whose list has not rows x cols elements yields nothing, so a later
    coalesce keeps the initial value; neither does one without a shape.
    Elements of a row gather in one group of ``cols`` numbers."""
    counts = flat.groupBy("param").agg(F.count("*").alias("_n"))
    good = counts.join(shapes, "param").where(F.col("_n") == F.col("rows") * F.col("cols")).select("param", "cols")
    rows = flat.join(good, "param").groupBy("param", F.expr("k div cols").alias("row_id")).agg(
        F.array_sort(F.collect_list(F.struct("k", "v"))).alias("_c")
    )
    return rows.select("param", "row_id", F.transform("_c", lambda x: x["v"]).alias("vec"))


def flatten_matrix(params: DataFrame, name: str) -> DataFrame:
    """flatten_all of one parameter."""
    return flatten_all(params.where(F.col("param") == name))


def unflatten_matrix(flat: DataFrame, name: str, rows: int, cols: int) -> DataFrame:
    """unflatten_all of one parameter of a given shape."""
    spark = flat.sparkSession
    shape = spark.createDataFrame([(name, rows, cols)], "param string, rows bigint, cols bigint")
    return unflatten_all(flat.where(F.col("param") == name), shape)
