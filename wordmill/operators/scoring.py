"""Batch scoring: logits, next-token distributions, per-window loss, evaluation.

The vocabulary may have any size: embedding rows are joined to the ids that
need them, and logits exist only inside the block pairs of ``blocked``. What
leaves a task is one mergeable state per row and vocabulary block, never a row
of V numbers unless the caller asks for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocked import Model, best_tokens, hidden_table, load_model, logit_blocks, softmax_states
from .params import ModelShape
from .windows import eval_windows

LOSS_EPS = 1e-10  # fixed value: added to p before the log


def broadcast_model(params: DataFrame, shape: ModelShape) -> Model:
    """Handle of a model: its table, and the layers broadcast. Keep it over
    calls with the same weights."""
    return load_model(params, shape)


def loss_of(top: str = "top", z: str = "z", goal: str = "goal"):
    """(p, loss) from a softmax state: p = exp(goal - top) / z, and
    -ln(p + 1e-10); 0 and 0 without a target in the vocabulary."""
    p = F.coalesce(F.exp(F.col(goal) - F.col(top)) / F.col(z), F.lit(0.0))
    return p, F.when(F.col(goal).isNull(), 0.0).otherwise(-F.log(p + F.lit(LOSS_EPS)))


def window_loss(
    windows: DataFrame, params: DataFrame, shape: ModelShape, key: str = "seq_id", model: Model | None = None
) -> DataFrame:
    """(key, i, target, p, loss) per window: p = softmax(last logits)[target],
    loss = -ln(p + 1e-10); 0 for an empty input or a target outside V."""
    model = model or load_model(params, shape)
    named = windows.select(F.col(key).cast("bigint").alias(key), "i", "input", "target", (F.size("input") > 0).alias("some"))
    h = stored(hidden_table(named, model, shape, "input"), "hidden")
    states = softmax_states(h.where("some"), h.count(), model, shape, ["__r"], "target")
    p, loss = loss_of()
    out = h.drop("h").join(states, "__r", "left")
    return out.select(key, F.col("i").cast("bigint").alias("i"), F.col("target").cast("bigint").alias("target"), p.alias("p"), loss.alias("loss"))


def evaluate(
    seqs: DataFrame, params: DataFrame, shape: ModelShape, key: str = "seq_id", model: Model | None = None
) -> DataFrame:
    """Mean loss over all evaluation windows (up to 20 ids); 0 with no windows.
    Also the count and the perplexity exp(mean)."""
    losses = window_loss(eval_windows(seqs, key), params, shape, key, model)
    agg = losses.agg(F.count(F.lit(1)).cast("bigint").alias("n_windows"), F.avg("loss").alias("_m"))
    return agg.select(
        "n_windows",
        F.coalesce(F.col("_m"), F.lit(0.0)).alias("mean_loss"),
        F.exp(F.coalesce(F.col("_m"), F.lit(0.0))).alias("perplexity"),
    )


def predict_next(
    seqs: DataFrame,
    params: DataFrame,
    shape: ModelShape,
    key: str | list[str] = "seq_id",
    ids: str = "ids",
    top: int | None = None,
    model: Model | None = None,
) -> DataFrame:
    """softmax of the last position's logits: (key, token_id, p); the key may
    be several columns. An empty sequence has the state zero.

    ``top=None`` emits all V rows per sequence (only for a bounded set of
    sequences).  With ``top=k`` the job emits the k most likely tokens not
    in the sequence (ties to the lesser id) plus every token already in it:
    exactly the rows the decoding filters can change (see generate_batch)."""
    model = model or load_model(params, shape)
    keys = [key] if isinstance(key, str) else list(key)
    named = seqs.select(*keys, ids, F.array_distinct(ids).alias("__seen"))
    h = stored(hidden_table(named, model, shape, ids), "hidden")
    some = None if top is None or top >= shape.vocab_size else top
    found = best_tokens(h, h.count(), model, shape, ["__r"], "__seen", some)
    return found.join(h.select("__r", *keys), "__r").select(*keys, "token_id", "p")


def forward_logits(
    seqs: DataFrame,
    params: DataFrame,
    shape: ModelShape,
    key: str = "seq_id",
    ids: str = "ids",
    model: Model | None = None,
    summary: bool = False,
) -> DataFrame:
    """Logits for every position of each sequence.

    ``summary=False``: (key, pos, logits ARRAY<DOUBLE> of V), for a bounded
    set of sequences.  ``summary=True``: the logits are reduced inside the
    job to (key, pos, top_token, top_logit, lse), so a whole table can be
    scored without V numbers per position leaving the task."""
    model = model or load_model(params, shape)
    h = stored(hidden_table(seqs.select(key, ids), model, shape, ids, every=True), "hidden")
    at = ["__r", "pos"]
    if not summary:
        found = logit_blocks(h, h.count(), model, shape, at)
        return found.join(h.select(key, *at), at).select(key, "pos", "logits")
    found = softmax_states(h, h.count(), model, shape, at).join(h.select(key, *at), at)
    lse = (F.col("top") + F.log("z")).alias("lse")
    return found.select(key, "pos", F.col("token").alias("top_token"), F.col("top").alias("top_logit"), lse)
