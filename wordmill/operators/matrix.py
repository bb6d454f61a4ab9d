"""Matrix algebra on tables.

A matrix is a coordinate table (i BIGINT, j BIGINT, v DOUBLE); a missing
cell reads 0.  With ``key`` columns (say ``m``), one call works on many
matrices, each by itself.  Products are worked in tiles: cells gather into dense
blocks, each pair of blocks that meet is one BLAS call, and the partial blocks
are summed map-side.  Row statistics (softmax, layer norm) are windows over a
row, so the input is computed once; a row's cells spill if they must.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.activations import gelu, relu, sigmoid, tanh
from ..functions.random import hash_symmetric, hash_uniform
from ..session import ship_package
from ._util import add_vectors

Shape = tuple[int, int]


def q6(c: Column) -> Column:
    """Round to 6 decimals the same way in Spark and DuckDB (and no -0.0)."""
    return F.round(c * 1e6) / 1e6 + 0.0


def _check(cond: bool, msg: str) -> None:
    if not cond:
        raise ValueError(msg)


def matrix_zeros(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    if cols <= 0 or rows <= 0:
        return spark.createDataFrame([], "i bigint, j bigint, v double")
    cells = spark.range(rows).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("j"))
    return cells.select("i", F.col("j").cast("bigint"), F.lit(0.0).alias("v"))


ROWS_AT_ONCE = 1 << 16


def _cells_of(shapes: DataFrame, key: list[str]) -> DataFrame:
    """shapes(key, rows, cols) -> (key, rows, cols, i, j) of every cell. Rows
    come in runs of ROWS_AT_ONCE that are dealt out, so one large matrix is the
    work of many tasks."""
    some = shapes.where((F.col("rows") > 0) & (F.col("cols") > 0))
    runs = some.select(*key, "rows", "cols", F.explode(F.expr(f"sequence(0L, (rows - 1) div {ROWS_AT_ONCE})")).alias("_r"))
    dealt = runs.repartition(*key, "_r")
    first = f"_r * {ROWS_AT_ONCE}"
    rows = dealt.select(*key, "rows", "cols", F.explode(F.expr(f"sequence({first}, least({first} + {ROWS_AT_ONCE}, rows) - 1)")).alias("i"))
    return rows.select(*key, "rows", "cols", "i", F.explode(F.expr("sequence(0L, cols - 1)")).alias("j"))


def zeros_of(shapes: DataFrame, key: list[str]) -> DataFrame:
    """A matrix of zeros for each row of shapes(key, rows, cols)."""
    return _cells_of(shapes, key).select(*key, "i", "j", F.lit(0.0).alias("v"))


def random_of(shapes: DataFrame, key: list[str], seed: int, name: str) -> DataFrame:
    """Uniform in [-1, 1) per cell, a pure function of (seed, name, key, i, j)."""
    draw = hash_symmetric(seed, name, *key, F.col("i"), F.col("j"))
    return _cells_of(shapes, key).select(*key, "i", "j", draw.alias("v"))


def xavier_of(shapes: DataFrame, key: list[str], seed: int, name: str) -> DataFrame:
    """random_of, scaled by sqrt(6 / (rows + cols)) of its matrix."""
    draw = hash_symmetric(seed, name, *key, F.col("i"), F.col("j")) * F.sqrt(F.lit(6.0) / (F.col("rows") + F.col("cols")))
    return _cells_of(shapes, key).select(*key, "i", "j", draw.alias("v"))


def matrix_from_rows(df: DataFrame, row: str, vec: str) -> DataFrame:
    """Rows of arrays -> cells.  The column count is that of the first row
    (lowest number); longer rows are cut, shorter rows padded with 0."""
    first = df.agg(F.min_by(F.size(vec), F.col(row)).alias("c")).first()["c"]
    if not first or first < 0:
        return df.sparkSession.createDataFrame([], "i bigint, j bigint, v double")
    whole = F.slice(F.concat(F.col(vec).cast("array<double>"), F.array_repeat(F.lit(0.0), first)), 1, first)
    cells = df.select(F.col(row).cast("bigint").alias("i"), F.posexplode(whole).alias("j", "v"))
    return cells.select("i", F.col("j").cast("bigint"), F.coalesce("v", F.lit(0.0)).alias("v"))


def matrix_random(spark: SparkSession, rows: int, cols: int, seed: int, name: str) -> DataFrame:
    """Uniform in [-1, 1), a pure function of (seed, name, i, j)."""
    z = matrix_zeros(spark, rows, cols)
    return z.select("i", "j", hash_symmetric(seed, name, F.col("i"), F.col("j")).alias("v"))


def xavier_limit(rows: int, cols: int) -> float:
    return math.sqrt(6.0 / float(rows + cols))


def matrix_xavier(spark: SparkSession, rows: int, cols: int, seed: int, name: str) -> DataFrame:
    lim = xavier_limit(rows, cols)
    return matrix_random(spark, rows, cols, seed, name).select("i", "j", (F.col("v") * F.lit(lim)).alias("v"))


def matrix_set(m: DataFrame, updates: DataFrame, order: str | None = None, key: list[str] | None = None) -> DataFrame:
    """Write cells of a dense matrix; updates outside it match no cell and are
    ignored.  Of several updates of a cell the last by ``order`` wins (without
    it, the one with the largest value), so a cell never doubles."""
    at = [*(key or []), "i", "j"]
    last = F.max_by("v", F.col(order) if order else F.col("v"))
    u = updates.groupBy(*at).agg(last.alias("_new"))
    return m.join(u, at, "left").select(*at, F.coalesce(F.col("_new"), F.col("v")).alias("v"))


def matrix_get(m: DataFrame, cells: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Read cells; a cell outside the matrix (or missing) reads 0."""
    return cells.join(m, [*(key or []), "i", "j"], "left").withColumn("v", F.coalesce(F.col("v"), F.lit(0.0)))


TILE = 64  # rows and columns of a block of a product


def _tiles(m: DataFrame, key: list[str], names: tuple[str, str], out: str) -> DataFrame:
    """Cells -> (key, block row, block column, flat dense block of TILE x TILE)."""
    r, c = names
    at = F.struct(((F.col("i") % TILE) * TILE + F.col("j") % TILE).cast("int").alias("at"), F.col("v").alias("v"))
    blocks = m.groupBy(*key, F.expr(f"i div {TILE}").alias(r), F.expr(f"j div {TILE}").alias(c)).agg(F.collect_list(at).alias(out))
    return blocks


def matrix_multiply(
    a: DataFrame,
    b: DataFrame,
    a_shape: Shape | None = None,
    b_shape: Shape | None = None,
    key: list[str] | None = None,
) -> DataFrame:
    """A B, a matrix per key.  Both sides gather into blocks of TILE x TILE cells;
    blocks that share the inner index are multiplied by BLAS, and the partial
    blocks of a result block are added position by position, map-side first.
    Cells that are missing count as 0; a result block has all its cells up to
    the last row of A and the last column of B in that block."""
    if a_shape and b_shape:
        _check(a_shape[1] == b_shape[0], f"a product of {a_shape} and {b_shape}: the inner sizes differ")
    ship_package(a.sparkSession)
    k = key or []
    left, right = _tiles(a, k, ("_ti", "_tk"), "_x"), _tiles(b, k, ("_tk", "_tj"), "_y")
    pairs = left.join(right, [*k, "_tk"]).select(*k, "_ti", "_tj", "_x", "_y")
    head = [f for f in pairs.schema.fields if f.name not in ("_x", "_y")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head) + ", i int, vec array<double>"

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dense(cells) -> np.ndarray:
            out = np.zeros(TILE * TILE)
            flat = cells.values
            out[flat.field("at").to_numpy()] = flat.field("v").to_numpy(zero_copy_only=False)
            return out.reshape(TILE, TILE)

        for batch in batches:
            x, y = batch.column("_x"), batch.column("_y")
            for n in range(batch.num_rows):
                p, q = x[n], y[n]
                rows = int(p.values.field("at").to_numpy().max()) // TILE + 1
                cols = int((q.values.field("at").to_numpy() % TILE).max()) + 1
                part = dense(p)[:rows] @ dense(q)[:, :cols]
                line = pa.array(np.zeros(rows, np.int32))
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (rows + 1) * cols, cols, dtype=np.int32)), pa.array(part.reshape(-1))
                )
                same = batch.select([f.name for f in head]).slice(n, 1).take(line)
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(np.arange(rows, dtype=np.int32)), flat],
                    names=[*(f.name for f in head), "i", "vec"],
                )

    parts = pairs.mapInArrow(products, schema)
    sums = add_vectors(parts, [*k, "_ti", "_tj", "i"])
    cells = sums.select(*k, (F.col("_ti") * TILE + F.col("i")).alias("i"), "_tj", F.posexplode("vec").alias("_j", "v"))
    return cells.select(*k, "i", (F.col("_tj") * TILE + F.col("_j")).alias("j"), "v")


def _elementwise(a: DataFrame, b: DataFrame, op: Callable[[Column, Column], Column], key: list[str] | None) -> DataFrame:
    at = [*(key or []), "i", "j"]
    x = a.select(*at, F.col("v").alias("_a"))
    y = b.select(*at, F.col("v").alias("_b"))
    j = x.join(y, at, "full")
    return j.select(*at, op(F.coalesce(F.col("_a"), F.lit(0.0)), F.coalesce(F.col("_b"), F.lit(0.0))).alias("v"))


def _same_shape(what: str, a: Shape | None, b: Shape | None) -> None:
    if a and b:
        _check(a == b, f"{what} of {a} and {b}: the shapes differ")


def matrix_add(
    a: DataFrame, b: DataFrame, a_shape: Shape | None = None, b_shape: Shape | None = None, key: list[str] | None = None
) -> DataFrame:
    _same_shape("a sum", a_shape, b_shape)
    return _elementwise(a, b, lambda x, y: x + y, key)


def matrix_hadamard(
    a: DataFrame, b: DataFrame, a_shape: Shape | None = None, b_shape: Shape | None = None, key: list[str] | None = None
) -> DataFrame:
    _same_shape("a product by cell", a_shape, b_shape)
    return _elementwise(a, b, lambda x, y: x * y, key)


def matrix_scale(m: DataFrame, s: float, key: list[str] | None = None) -> DataFrame:
    return m.select(*(key or []), "i", "j", (F.col("v") * F.lit(float(s))).alias("v"))


def matrix_transpose(m: DataFrame, key: list[str] | None = None) -> DataFrame:
    return m.select(*(key or []), F.col("j").alias("i"), F.col("i").alias("j"), "v")


def matrix_apply(m: DataFrame, fn: Callable[[Column], Column], key: list[str] | None = None) -> DataFrame:
    return m.select(*(key or []), "i", "j", fn(F.col("v")).alias("v"))


def matrix_relu(m):
    return matrix_apply(m, relu)


def matrix_sigmoid(m):
    return matrix_apply(m, sigmoid)


def matrix_tanh(m):
    return matrix_apply(m, tanh)


def matrix_gelu(m):
    return matrix_apply(m, gelu)


def row_softmax(m: DataFrame, key: list[str] | None = None) -> DataFrame:
    """exp(v - row max) / row sum, per row i (and per extra key columns)."""
    k = [*(key or []), "i"]
    row = Window.partitionBy(*k)
    shifted = m.withColumn("_e", F.exp(F.col("v") - F.max("v").over(row)))
    return shifted.select(*k, "j", (F.col("_e") / F.sum("_e").over(row)).alias("v"))


def row_layer_norm(m: DataFrame, eps: float = 1e-6, key: list[str] | None = None) -> DataFrame:
    """(v - row mean) / sqrt(population variance + eps)."""
    k = [*(key or []), "i"]
    row = Window.partitionBy(*k)
    spread = F.sqrt(F.var_pop("v").over(row) + F.lit(eps))
    return m.select(*k, "j", ((F.col("v") - F.avg("v").over(row)) / spread).alias("v"))


def dropout(m: DataFrame, rate: float, training: bool, seed: int = 0, name: str = "dropout") -> DataFrame:
    """Keep a cell when its hash-uniform draw exceeds the rate, scaled by
    1/(1-rate); identity when not training or the rate is 0."""
    if not training or rate == 0:
        return m
    scale = 1.0 / (1.0 - rate)
    u = hash_uniform(seed, name, F.col("i"), F.col("j"))
    return m.select("i", "j", F.when(u > F.lit(rate), F.col("v") * F.lit(scale)).otherwise(F.lit(0.0)).alias("v"))


def matrix_shape(m: DataFrame) -> Shape:
    """(max i + 1, max j + 1): one small aggregate."""
    r = m.agg(F.max("i"), F.max("j")).first()
    return (0, 0) if r[0] is None else (int(r[0]) + 1, int(r[1]) + 1)
