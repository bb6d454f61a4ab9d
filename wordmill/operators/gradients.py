"""Gradients and the Adam update as table operations.

Gradient tables are ``(param, row_id, vec ARRAY<DOUBLE>)`` with only the rows
that exist; an absent row is zero.  Sums are plain sums of pieces of the
vectors, so the partial aggregate runs map-side and a hot row (say the output
row of a frequent token) is pre-summed per partition.

The backward pass is the reference's: the last position's dlogits = p - y;
the output gradient is x_last (p - y)^T and the embedding row of the last
input id gets (p - y) W_out^T; blocks and layer norms pass the gradient
through unchanged and get none themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ._util import add_vectors
from .blocked import Model, hidden_table, softmax_gradients, softmax_states
from .params import ModelShape
from .scoring import loss_of

GRADS_SCHEMA = "param string, row_id bigint, vec array<double>"
LOSS_PARAM = "__loss__"  # one row: vec = [loss sum, windows]
CLIPPED = ("embedding", "output_layer")


@dataclass(frozen=True)
class AdamConfig:
    # Fixed defaults of the reference's optimiser.
    learning_rate: float = 0.001
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8
    weight_decay: float = 0.01
    clamp: float = 10.0


def updated_params(shape: ModelShape) -> list[str]:
    """Parameters the optimiser touches: embedding, output, final norm, and
    each block's two layer-norm gammas."""
    names = ["embedding", "output_layer", "final_ln_gamma", "final_ln_beta"]
    for layer in range(shape.num_layers):
        names += [f"transformer_{layer}_ln1_gamma", f"transformer_{layer}_ln2_gamma"]
    return names


def window_gradients(
    windows: DataFrame,
    model: Model,
    shape: ModelShape,
    key: str = "sample_no",
    training: bool = True,
    seed: int = 0,
    step: int = 0,
) -> DataFrame:
    """Summed gradients of the windows (key, input, target): partial sums per
    pair of a window block and a vocabulary block, and one row with the loss sum
    and the number of windows. Two passes over the output rows, one for the
    softmax of every window and one for the sums; no task holds all V rows.
    Windows without ids count, with no loss and no gradient."""
    named = windows.select(key, "input", "target", F.element_at("input", -1).alias("last"), (F.size("input") > 0).alias("some"))
    masks = (key, seed, step) if training and shape.dropout > 0 else None
    h = stored(hidden_table(named, model, shape, "input", dropout=masks), "hidden")
    n = h.count()
    states = stored(softmax_states(h.where("some"), n, model, shape, ["__r"], "target"), "softmax")
    ready = h.select("__r", "h", "target", "last").join(states, "__r")
    grads = softmax_gradients(ready, n, model, shape, ["__r"])
    total = states.agg(F.array(F.coalesce(F.sum(loss_of()[1]), F.lit(0.0)), F.lit(float(n))).alias("vec"))
    if n:
        grads = grads.unionByName(total.select(F.lit(LOSS_PARAM).alias("param"), F.lit(0).cast("bigint").alias("row_id"), "vec"))
    return grads


def to_long(grads: DataFrame) -> DataFrame:
    return grads.select("param", "row_id", F.posexplode("vec").alias("k", "g"))


def from_long(long: DataFrame, value: str = "g") -> DataFrame:
    """(param, row_id, k, value) -> (param, row_id, vec); a group is one
    row of D numbers."""
    return long.groupBy("param", "row_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("k"), F.col(value).alias("x")))), lambda s: s["x"]).alias("vec")
    )


def sum_gradients(*grads: DataFrame) -> DataFrame:
    """Add gradient tables: vectors summed element-wise by (param, row_id)."""
    u = grads[0]
    for g in grads[1:]:
        u = u.unionByName(g)
    return add_vectors(u, ["param", "row_id"])


def sum_gradients_long(*grads: DataFrame) -> DataFrame:
    """Same through the long form (param, row_id, k): a row per cell."""
    u = grads[0]
    for g in grads[1:]:
        u = u.unionByName(g)
    return from_long(to_long(u).groupBy("param", "row_id", "k").agg(F.sum("g").alias("g")))


def scale_gradients(grads: DataFrame, factor: float | Column, only: tuple[str, ...] = CLIPPED) -> DataFrame:
    """x factor for the embedding and output rows; other rows unchanged."""
    f = factor if isinstance(factor, Column) else F.lit(float(factor))
    scaled = F.transform("vec", lambda x: x * f)
    return grads.withColumn("vec", F.when(F.col("param").isin(*only), scaled).otherwise(F.col("vec")))


def grad_norm(grads: DataFrame, only: tuple[str, ...] = CLIPPED) -> float:
    """L2 norm over embedding and output gradients (one scalar to the driver)."""
    sq = grads.where(F.col("param").isin(*only)).select(
        F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x).alias("s")
    )
    total = sq.agg(F.sum("s")).first()[0] or 0.0
    return float(np.sqrt(total))


def clip_gradients(grads: DataFrame, max_norm: float) -> tuple[DataFrame, float]:
    """If the norm exceeds max_norm, scale by max_norm / norm."""
    norm = grad_norm(grads)
    if max_norm > 0 and norm > max_norm:
        return scale_gradients(grads, max_norm / norm), norm
    return grads, norm


def zero_gradients(params: DataFrame, grads: DataFrame) -> DataFrame:
    """Gradients in the model's shape: every parameter row, zeros where the
    gradient table has no row."""
    g = grads.select("param", "row_id", F.col("vec").alias("_g"))
    return params.select("param", "row_id", F.size("vec").alias("_n")).join(g, ["param", "row_id"], "left").select(
        "param", "row_id", F.coalesce(F.col("_g"), F.array_repeat(F.lit(0.0), F.col("_n"))).alias("vec")
    )


def adam_state(params: DataFrame) -> DataFrame:
    """Zero first and second moments next to each parameter row."""
    z = F.transform("vec", lambda x: F.lit(0.0))
    return params.withColumn("m", z).withColumn("v", z)


def effective_lr(lr: float, t: Column, beta1: float = 0.9, beta2: float = 0.999) -> Column:
    """lr sqrt(1 - beta2^t) / (1 - beta1^t); lr at t = 0."""
    tt = t.cast("double")
    return F.when(t == 0, F.lit(lr)).otherwise(
        F.lit(lr) * F.sqrt(F.lit(1.0) - F.pow(F.lit(beta2), tt)) / (F.lit(1.0) - F.pow(F.lit(beta1), tt))
    )


def warmup_lr(lr: float, t: Column, warmup: int) -> Column:
    """Rate after t steps: the base rate before the first step, lr t / warmup
    while t < warmup, and from then on the last value that was set."""
    if warmup < 2:
        return F.lit(lr)
    last = F.least(t, F.lit(warmup - 1)).cast("double")
    return F.when(t < 1, F.lit(lr)).otherwise(F.lit(lr) * last / F.lit(float(warmup)))


def step_size(cfg: AdamConfig, t: int) -> float:
    import math

    return cfg.learning_rate * math.sqrt(1.0 - cfg.beta2**t) / (1.0 - cfg.beta1**t)


def adam_step(state: DataFrame, grads: DataFrame, t: int, cfg: AdamConfig, names: list[str]) -> DataFrame:
    """One Adam step (t >= 1) on the rows of the listed parameters; others
    pass through.  Absent gradient rows count as zero, so weight decay still
    moves every weight of an updated parameter."""
    lr_t = step_size(cfg, t)
    g = grads.select("param", "row_id", F.col("vec").alias("_g"))
    joined = state.join(g, ["param", "row_id"], "left")
    zeros = F.array_repeat(F.lit(0.0), F.size("vec"))
    gz = F.coalesce(F.col("_g"), zeros)

    def cell(i):
        w, m, v, gr = F.get("_w", i), F.get("_m", i), F.get("_v", i), F.get("_gz", i)
        if cfg.weight_decay > 0:
            gr = gr + F.lit(cfg.weight_decay) * w
        m2 = F.lit(cfg.beta1) * m + F.lit(1 - cfg.beta1) * gr
        v2 = F.lit(cfg.beta2) * v + F.lit(1 - cfg.beta2) * gr * gr
        w2 = w - F.lit(lr_t) * m2 / (F.sqrt(v2) + F.lit(cfg.epsilon))
        return F.greatest(F.least(w2, F.lit(cfg.clamp)), F.lit(-cfg.clamp)), m2, v2

    # inputs renamed so that no output alias can shadow them inside the lambdas
    upd = joined.select(
        "param", "row_id", F.col("vec").alias("_w"), F.col("m").alias("_m"), F.col("v").alias("_v"), gz.alias("_gz")
    )
    idx = F.sequence(F.lit(0), F.size("_w") - 1)
    hit = F.col("param").isin(*names) & (F.size("_w") > 0)
    return upd.select(
        "param",
        "row_id",
        F.when(hit, F.transform(idx, lambda i: cell(i)[0])).otherwise(F.col("_w")).alias("vec"),
        F.when(hit, F.transform(idx, lambda i: cell(i)[1])).otherwise(F.col("_m")).alias("m"),
        F.when(hit, F.transform(idx, lambda i: cell(i)[2])).otherwise(F.col("_v")).alias("v"),
    )


def output_gradient(scores: DataFrame, hidden: DataFrame, key: str = "seq_id") -> DataFrame:
    """Relational form: sum over sequences of x (p - onehot(target)) per
    token: scores (key, token_id, p), hidden (key, vec, target) ->
    (param 'output_layer', row_id = token_id, vec)."""
    j = scores.join(hidden.select(key, "vec", "target"), key)
    d = F.col("p") - F.when(F.col("token_id") == F.col("target"), F.lit(1.0)).otherwise(F.lit(0.0))
    long = j.select(F.col("token_id").alias("row_id"), F.posexplode("vec").alias("k", "x"), d.alias("d"))
    agg = long.groupBy("row_id", "k").agg(F.sum(F.col("x") * F.col("d")).alias("g"))
    return from_long(agg.withColumn("param", F.lit("output_layer")))


def embedding_gradient(rows: DataFrame, token: str = "token_id", vec: str = "vec") -> DataFrame:
    """Add each window's row gradient to its last input token's row."""
    long = rows.select(F.col(token).alias("row_id"), F.posexplode(vec).alias("k", "x"))
    agg = long.groupBy("row_id", "k").agg(F.sum("x").alias("g"))
    return from_long(agg.withColumn("param", F.lit("embedding")))
