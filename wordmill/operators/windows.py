"""Next-token training windows, sampling, batching and the training plan.

Windows stay as (seq, i) -> slice of the sequence array: built by a narrow
explode, never by a shuffle; sampling draws k global window numbers and finds
their sequences with a bucketed equi-join instead of a range scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.random import hash_draw
from ..session import stored
from ._util import global_prefix_sum, global_rank
from .tokens import encode, word_counts

EVAL_WINDOW = 20
FEW_DRAWS = 1 << 17  # draws that are broadcast, so that the sequences are not shuffled to meet them


def window_input(ids, i, max_len: int):
    """Last min(i+1, L) ids ending at index i (0-based)."""
    n = F.least(i + 1, F.lit(max_len))
    return F.slice(ids, (i + 2 - n).cast("int"), n.cast("int"))


def next_token_windows(
    seqs: DataFrame, max_len: int, key: str = "seq_id", ids: str = "ids", chunk: int | None = None
) -> DataFrame:
    """(key, i, input, target) for i in 0..n-2; sequences under 2 ids give none.

    Default: a narrow explode, no shuffle.  ``chunk=C`` is the skew-safe
    form for corpora where one sequence may hold a large share of all ids:
    each sequence is cut into pieces of C windows (plus the L-1 ids of
    context before them), the pieces are spread round-robin, and windows are
    exploded there, so a huge document is windowed by many tasks."""
    if chunk:
        return _chunked_windows(seqs, max_len, key, ids, chunk)
    size = F.size(ids)
    idx = F.when(size >= 2, F.sequence(F.lit(0), size - 2)).otherwise(F.array().cast("array<int>"))
    exploded = seqs.select(key, ids, F.explode(idx).alias("i"))
    return exploded.select(
        key,
        F.col("i").cast("bigint").alias("i"),
        window_input(F.col(ids), F.col("i"), max_len).alias("input"),
        F.get(F.col(ids), F.col("i") + 1).alias("target"),
    )


def _chunked_windows(seqs: DataFrame, max_len: int, key: str, ids: str, chunk: int) -> DataFrame:
    n_win = F.greatest(F.size(ids) - 1, F.lit(0))
    n_chunks = F.ceil(n_win / F.lit(chunk)).cast("int")
    parts = seqs.select(
        key, ids, n_win.alias("_nw"),
        F.explode(F.when(n_chunks > 0, F.sequence(F.lit(0), n_chunks - 1)).otherwise(F.array().cast("array<int>"))).alias("_c"),
    )
    first = F.col("_c") * chunk
    last = F.least(first + chunk, F.col("_nw")) - 1
    base = F.greatest(first - (max_len - 1), F.lit(0))
    pieces = parts.select(
        key, F.col("_c"), base.alias("_base"), first.alias("_first"), last.alias("_last"),
        F.slice(F.col(ids), (base + 1).cast("int"), (last + 2 - base).cast("int")).alias("_piece"),
    )
    spread = pieces.repartition(max(seqs.sparkSession.sparkContext.defaultParallelism, 1))
    local = spread.select(key, "_base", "_piece", F.explode(F.sequence(F.col("_first"), F.col("_last"))).alias("i"))
    li = F.col("i") - F.col("_base")
    return local.select(
        key,
        F.col("i").cast("bigint").alias("i"),
        window_input(F.col("_piece"), li, max_len).alias("input"),
        F.get(F.col("_piece"), li + 1).alias("target"),
    )


def eval_windows(seqs: DataFrame, key: str = "seq_id", ids: str = "ids") -> DataFrame:
    return next_token_windows(seqs, EVAL_WINDOW, key, ids)


def all_windows(seqs: DataFrame, max_len: int, seed: int = 0, epoch: int = 0, key: str = "seq_id", ids: str = "ids") -> DataFrame:
    """Every window once, numbered by a random order of this epoch (ties by key
    and i): (key, i, input, target, sample_no).  The key is unique."""
    drawn = hash_draw(seed, "order", F.lit(epoch), F.col(key), F.col("i"))
    wins = next_token_windows(seqs, max_len, key, ids).withColumn("_u", drawn)
    return global_rank(wins, ["_u", key, "i"], "sample_no", start=0).drop("_u")


def _draw(counts: DataFrame, k: int, seed: int, epoch: int, key: str) -> DataFrame | None:
    """counts(key, cnt) -> (sample_no, key, i): k windows drawn uniformly with
    replacement over all windows, by their global numbers g = offset of the
    sequence + i; a draw has 52 bits. None if there is nothing to draw from."""
    offs = global_prefix_sum(counts.where("cnt > 0"), [key], "cnt", "off")
    total = offs.agg(F.sum("cnt")).first()[0] or 0
    if total == 0 or k <= 0:
        return None
    draws = counts.sparkSession.range(k).select(
        F.col("id").alias("sample_no"),
        F.floor(hash_draw(seed, "sample", F.lit(epoch), F.col("id")) * F.lit(float(total))).cast("bigint").alias("g"),
    )
    # Bucketed range join: a sequence is listed once per bucket its window
    # range touches; a draw looks up its one bucket.
    width = max(1, math.ceil(total / max(4 * k, 1)))
    spans = offs.select(
        key, "off", "cnt",
        F.explode(F.sequence(F.floor(F.col("off") / width), F.floor((F.col("off") + F.col("cnt") - 1) / width))).alias("b"),
    )
    keyed = draws.withColumn("b", F.floor(F.col("g") / width))
    return spans.join(_few(keyed, k), "b").where(
        (F.col("g") >= F.col("off")) & (F.col("g") < F.col("off") + F.col("cnt"))
    ).select("sample_no", key, (F.col("g") - F.col("off")).alias("i"))


def _few(draws: DataFrame, k: int) -> DataFrame:
    """draws, at most k rows, marked for a broadcast if they are few."""
    return F.broadcast(draws) if k <= FEW_DRAWS else draws


def _pick(seqs: DataFrame, hits: DataFrame, k: int, max_len: int, key: str, ids: str) -> DataFrame:
    return seqs.select(key, ids).join(_few(hits, k), key).select(
        "sample_no", key, "i",
        window_input(F.col(ids), F.col("i"), max_len).alias("input"),
        F.get(F.col(ids), F.col("i").cast("int") + 1).alias("target"),
    )


def _no_samples(seqs: DataFrame, key: str) -> DataFrame:
    kind = seqs.schema[key].dataType.simpleString()
    return seqs.sparkSession.createDataFrame([], f"sample_no bigint, {key} {kind}, i bigint, input array<bigint>, target bigint")


def sample_windows(
    seqs: DataFrame, k: int, max_len: int, seed: int = 0, epoch: int = 0, key: str = "seq_id", ids: str = "ids"
) -> DataFrame:
    """k windows drawn uniformly with replacement over all windows of all
    sequences: (sample_no, key, i, input, target)."""
    counts = seqs.select(key, F.greatest(F.size(ids) - 1, F.lit(0)).cast("bigint").alias("cnt"))
    hits = _draw(counts, k, seed, epoch, key)
    return _no_samples(seqs, key) if hits is None else _pick(seqs, hits, k, max_len, key, ids)


def sample_text_windows(
    docs: DataFrame,
    vocab: DataFrame,
    k: int,
    max_len: int,
    seed: int = 0,
    epoch: int = 0,
    key: str = "seq_id",
    text: str = "text",
) -> DataFrame:
    """sample_windows of encode(docs, vocab) that encodes only the texts drawn:
    a text of w words has w + 1 windows, whatever their ids."""
    counts = word_counts(docs, key, text).select(key, (F.col("words") + 1).alias("cnt"))
    hits = _draw(counts, k, seed, epoch, key)
    if hits is None:
        return _no_samples(docs, key)
    hits = stored(hits, "draws")
    drawn = docs.select(key, text).join(_few(hits.select(key).distinct(), k), key, "left_semi")
    return _pick(encode(drawn, vocab, key, text), hits, k, max_len, key, "ids")


def assign_batches(samples: DataFrame, batch_size: int, sample_no: str = "sample_no") -> DataFrame:
    return samples.withColumn("batch", F.floor(F.col(sample_no) / batch_size).cast("bigint"))


def chunk_batches(
    samples: DataFrame, batch_size: int, workers: int, n_samples: int, sample_no: str = "sample_no"
) -> DataFrame:
    """Worker of each sample inside its batch: chunks of (batch length div W),
    the last worker takes the rest."""
    batch = F.floor(F.col(sample_no) / batch_size)
    within = F.col(sample_no) - batch * batch_size
    length = F.least(F.lit(batch_size), F.lit(n_samples) - batch * batch_size)
    chunk = F.floor(length / workers)
    worker = F.when(chunk == 0, F.lit(workers - 1)).otherwise(F.least(F.floor(within / chunk), F.lit(workers - 1)))
    return samples.withColumn("batch", batch.cast("bigint")).withColumn("worker", worker.cast("bigint"))


# From a learning rate on, the window length, tokens per sample,
# most samples of an epoch, and the least batch bound of the training plan.
PLAN = (
    (0.05, 5, 50, 500, 32),
    (0.03, 8, 30, 800, 64),
    (0.0, 10, 20, 1000, 32),
)


def _tier(lr: float, batch: int, workers: int) -> tuple[int, int, int, int]:
    """(window length, tokens per sample, most samples, batch size) of a rate."""
    _, length, per, most, bound = next((t for t in PLAN if lr >= t[0]), PLAN[-1])
    return length, per, most, max(min(batch, bound), 4 * workers)


def plan_values(n_tokens: int, lr: float, batch: int, workers: int) -> dict:
    """Training sizes as the reference derives them from the learning rate."""
    max_len, per, most, b = _tier(lr, batch, workers)
    samples = min(n_tokens // per, most)
    return {
        "max_seq_len": max_len,
        "samples_per_epoch": samples,
        "batch_size": b,
        "n_batches": -(-samples // b) if samples > 0 else 0,
    }


def training_plan(stats: DataFrame, lr: float, batch: int, workers: int, n_tokens: str = "n_tokens") -> DataFrame:
    """One row per stats row: the plan as column expressions."""
    n = F.col(n_tokens)
    max_len, per, most, b = _tier(lr, batch, workers)
    samples = F.least(F.floor(n / per), F.lit(most))
    return stats.select(
        n.cast("bigint").alias(n_tokens),
        F.lit(max_len).cast("bigint").alias("max_seq_len"),
        samples.cast("bigint").alias("samples_per_epoch"),
        F.lit(b).cast("bigint").alias("batch_size"),
        F.ceil(samples / b).cast("bigint").alias("n_batches"),
    )
