"""Relational forms of the model's layers, over long activations
``X(seq_id, pos, k, x)``.

These state each layer as joins, grouped sums and windows so that SQL can
check them cell by cell.  Attention, feed-forward and the whole block bring a
sequence's rows together once and compute on arrays of row vectors.  The scoring
and training jobs use the numpy kernel in ``model.py`` on the same parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .params import ModelShape

SEQ = ["seq_id", "pos"]
VECTORS = ("ff_b1", "ff_b2", "ln1_gamma", "ln1_beta", "ln2_gamma", "ln2_beta")
LAYER = ("attn_query", "attn_key", "attn_value", "attn_output", "ff_w1", "ff_w2", *VECTORS)


def vector_cells(params: DataFrame, name: str) -> DataFrame:
    """(k, w) of a 1 x n parameter (bias, gamma, beta)."""
    return params.where((F.col("param") == name) & (F.col("row_id") == 0)).select(F.posexplode("vec").alias("k", "w"))


def embed_tokens(tokens: DataFrame, params: DataFrame, shape: ModelShape) -> DataFrame:
    """(seq_id, pos, token_id) -> X; an id outside the vocabulary embeds to zeros."""
    emb = params.where(F.col("param") == "embedding").select(F.col("row_id").alias("token_id"), "vec")
    zeros = F.array_repeat(F.lit(0.0), shape.embed_size)
    j = tokens.join(emb, "token_id", "left").select("seq_id", "pos", F.coalesce(F.col("vec"), zeros).alias("vec"))
    return j.select("seq_id", "pos", F.posexplode("vec").alias("k", "x"))


def positional_table(spark: SparkSession, max_len: int, d: int) -> DataFrame:
    """(pos, k, pe): even k sin(pos / 10000^(k/D)), odd k cos(pos / 10000^((k-1)/D))."""
    cells = spark.range(max_len).select(F.col("id").alias("pos"), F.explode(F.sequence(F.lit(0), F.lit(d - 1))).alias("k"))
    even = (F.col("k") - F.col("k") % 2).cast("double")
    angle = F.col("pos").cast("double") / F.pow(F.lit(10000.0), even / F.lit(float(d)))
    return cells.select("pos", F.col("k").cast("bigint"), F.when(F.col("k") % 2 == 0, F.sin(angle)).otherwise(F.cos(angle)).alias("pe"))


def position_vectors(tokens: DataFrame, max_len: int, d: int) -> DataFrame:
    """tokens(..., pos) -> the same rows with ``vec``: the position's vector of d
    numbers, computed in place; zeros from ``max_len`` on."""
    pos = F.col("pos").cast("double")

    def cell(k: Column) -> Column:
        angle = pos / F.pow(F.lit(10000.0), (k - k % 2).cast("double") / F.lit(float(d)))
        return F.when(F.col("pos") >= max_len, 0.0).when(k % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return tokens.withColumn("vec", F.transform(F.sequence(F.lit(0), F.lit(d - 1)), cell))


def add_positions(x: DataFrame, pe: DataFrame) -> DataFrame:
    """x + pe by (pos, k); positions beyond the table add nothing."""
    return x.join(F.broadcast(pe), ["pos", "k"], "left").select(
        "seq_id", "pos", "k", (F.col("x") + F.coalesce(F.col("pe"), F.lit(0.0))).alias("x")
    )


def layer_norm_affine(x: DataFrame, gamma: DataFrame, beta: DataFrame, eps: float) -> DataFrame:
    row = Window.partitionBy(*SEQ)
    spread = F.sqrt(F.var_pop("x").over(row) + F.lit(eps))
    n = x.select(*SEQ, "k", ((F.col("x") - F.avg("x").over(row)) / spread).alias("x"))
    # gamma and beta are one vector of the model each.
    n = n.join(F.broadcast(gamma.select("k", F.col("w").alias("_g"))), "k").join(F.broadcast(beta.select("k", F.col("w").alias("_b"))), "k")
    return n.select("seq_id", "pos", "k", (F.col("x") * F.col("_g") + F.col("_b")).alias("x"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, y: a + y)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda y, z: y * z))


def _transpose(m: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(F.get(m, F.lit(0))) - 1), lambda j: F.transform(m, lambda r: F.get(r, j)))


def _times(rows: Column, transposed: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(transposed, lambda c: _dot(r, c)))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda r, t: F.zip_with(r, t, lambda y, z: y + z))


def _rows(x: DataFrame, params: DataFrame, layer: int, body: Callable[[Column, Callable[[str], Column]], Column]) -> DataFrame:
    """X -> (seq_id, pos, vec) where ``body(rows, weight)`` maps the rows of one
    sequence, in the order of pos, to as many new rows.  One shuffle brings a sequence together;
    the layer's weights (D and H wide, whatever the vocabulary) come as one
    broadcast row, matrices transposed, so that an output is a dot product."""
    prefix = f"transformer_{layer}_"
    own = params.where(F.col("param").startswith(prefix))
    stored = own.groupBy("param").agg(F.sort_array(F.collect_list(F.struct("row_id", "vec")))["vec"].alias("m"))
    names = [prefix + n for n in LAYER]
    flat = stored.groupBy().agg(*[F.max(F.when(F.col("param") == n, F.col("m"))).alias(n) for n in names])
    weights = flat.select(
        F.lit(0).alias("_one"),
        *[(F.get(n, F.lit(0)) if n[len(prefix) :] in VECTORS else _transpose(F.col(n))).alias(n) for n in names],
    )
    cells = x.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("pos", "k", "x"))).alias("_cells"))
    d = F.size(F.array_distinct(F.col("_cells")["k"]))
    width = cells.withColumn("_d", d).withColumn("_one", F.lit(0))
    start = F.sequence(F.lit(1), F.size("_cells"), F.col("_d"))
    rows = F.transform(start, lambda i: F.slice(F.col("_cells")["x"], i, F.col("_d")))
    where = F.transform(start, lambda i: F.get(F.col("_cells")["pos"], i - 1))
    return width.join(F.broadcast(weights), "_one").select(
        "seq_id",
        F.explode(
            F.arrays_zip(where.alias("pos"), _let(rows, lambda r: body(r, lambda n: F.col(prefix + n))).alias("vec"))
        ).alias("_row"),
    ).select("seq_id", "_row.pos", "_row.vec")


def _cells(rows: DataFrame) -> DataFrame:
    return rows.select("seq_id", "pos", F.posexplode("vec").alias("k", "x"))


def _attention(rows: Column, weight: Callable[[str], Column], scale: float) -> Column:
    def of(qkv: Column) -> Column:
        def at(q: Column, i: Column) -> Column:
            scores = F.transform(F.slice(qkv["k"], 1, i + 1), lambda t: _dot(q, t) * F.lit(scale))
            shifted = _let(scores, lambda s: _let(F.array_max(s), lambda m: F.transform(s, lambda y: F.exp(y - m))))
            share = _let(shifted, lambda e: _let(_sum(e), lambda z: F.transform(e, lambda y: y / z)))
            return _let(share, lambda a: F.transform(qkv["v"], lambda channel: _dot(a, F.slice(channel, 1, i + 1))))

        return F.transform(qkv["q"], at)

    projected = F.struct(
        _times(rows, weight("attn_query")).alias("q"),
        _times(rows, weight("attn_key")).alias("k"),
        _let(_times(rows, weight("attn_value")), _transpose).alias("v"),
    )
    return _let(_let(projected, of), lambda o: _times(o, weight("attn_output")))


def _feed(rows: Column, weight: Callable[[str], Column]) -> Column:
    def one(r: Column) -> Column:
        hidden = F.transform(weight("ff_w1"), lambda c, j: _dot(r, c) + F.get(weight("ff_b1"), j))
        hot = F.transform(hidden, lambda h: _let(h, gelu_col))
        return _let(hot, lambda h: F.transform(weight("ff_w2"), lambda c, j: _dot(h, c) + F.get(weight("ff_b2"), j)))

    return F.transform(rows, one)


def _norm(rows: Column, gamma: Column, beta: Column, eps: float) -> Column:
    def one(r: Column) -> Column:
        def with_mean(mu: Column) -> Column:
            var = F.aggregate(r, F.lit(0.0), lambda a, y: a + (y - mu) * (y - mu)) / F.size(r)
            return _let(
                F.sqrt(var + F.lit(eps)),
                lambda sd: F.transform(r, lambda y, j: (y - mu) / sd * F.get(gamma, j) + F.get(beta, j)),
            )

        return _let(_sum(r) / F.size(r), with_mean)

    return F.transform(rows, one)


def causal_attention(x: DataFrame, params: DataFrame, layer: int, shape: ModelShape) -> DataFrame:
    """Single-head causal attention with the 4-head scale, as the reference
    computes it: softmax(Q K^T / sqrt(D/heads), t <= i) V W_out.  A sequence of
    any length is one row; its pairs are sums inside it, never rows."""
    return _cells(_rows(x, params, layer, lambda r, w: _attention(r, w, 1.0 / math.sqrt(shape.head_size))))


def gelu_col(x):
    return F.lit(0.5) * x * (F.lit(1.0) + F.tanh(F.lit(math.sqrt(2.0 / math.pi)) * (x + F.lit(0.044715) * x * x * x)))


def feed_forward(x: DataFrame, params: DataFrame, layer: int) -> DataFrame:
    """GeLU(x W1 + b1) W2 + b2."""
    return _cells(_rows(x, params, layer, _feed))


def transformer_block(x: DataFrame, params: DataFrame, layer: int, shape: ModelShape) -> DataFrame:
    """x + attn(LN1 x), then + ff(LN2 .), in inference mode (no dropout)."""
    return _cells(block_rows(x, params, layer, shape))


def block_rows(x: DataFrame, params: DataFrame, layer: int, shape: ModelShape) -> DataFrame:
    """transformer_block with one row (seq_id, pos, vec) per position."""

    def block(r: Column, w: Callable[[str], Column]) -> Column:
        n1 = _norm(r, w("ln1_gamma"), w("ln1_beta"), shape.eps)
        attended = _let(n1, lambda n: _plus(_attention(n, w, 1.0 / math.sqrt(shape.head_size)), r))

        def rest(x1: Column) -> Column:
            return _plus(_let(_norm(x1, w("ln2_gamma"), w("ln2_beta"), shape.eps), lambda n: _feed(n, w)), x1)

        return _let(attended, rest)

    return _rows(x, params, layer, block)
