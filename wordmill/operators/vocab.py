"""Vocabulary: ids by first occurrence, growth, sizes and token counts.

Vocabulary schema: (token STRING, id BIGINT, n BIGINT, first_doc BIGINT,
first_pos BIGINT).  The four special tokens are literal rows with ids 0..3.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPECIAL_TOKENS
from ..session import stored
from ._util import global_rank

VOCAB_SCHEMA = "token string, id bigint, n bigint, first_doc bigint, first_pos bigint"


def special_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(tok, i, 0, None, None) for tok, i in SPECIAL_TOKENS], VOCAB_SCHEMA
    )


# A place in the corpus as one number: (key + 2^63 + 1) * 2^32 + pos, and pos
# alone for a null key, which comes first. 97 bits, so a decimal of 38 digits.
_KEY_ZERO = 2**63 + 1
_POS_SPAN = 2**32


def _place(key: str) -> Column:
    shifted = F.coalesce(F.col(key).cast("decimal(20,0)") + F.lit(Decimal(_KEY_ZERO)), F.lit(0).cast("decimal(21,0)"))
    return (shifted * F.lit(Decimal(_POS_SPAN)) + F.col("pos").cast("decimal(10,0)")).cast("decimal(38,0)")


def first_places(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(token, n, first_doc, first_pos) of every word of the tokens.

    The first occurrence is a plain min over a number that orders places, for
    any 64-bit key, so the aggregate is a hash aggregate with partial results
    map-side: a hot token such as "," shuffles one row per partition, and the
    text is read once. A column n of the tokens counts occurrences."""
    n = F.sum("n") if "n" in tokens.columns else F.count(F.lit(1))
    agg = tokens.groupBy("token").agg(F.min(_place(key)).alias("_at"), n.cast("bigint").alias("n"))
    span, zero = F.lit(Decimal(_POS_SPAN)), F.lit(Decimal(_KEY_ZERO))
    pos = F.col("_at") % span
    shifted = ((F.col("_at") - pos) / span).cast("decimal(21,0)")  # divides without rest
    doc = F.when(shifted > 0, (shifted - zero).cast("bigint"))
    return agg.select("token", "n", doc.alias("first_doc"), pos.cast("bigint").alias("first_pos"))


def _firsts(tokens: DataFrame, key: str) -> DataFrame:
    return stored(first_places(tokens, key), "words")


def build_vocab(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids by order of first occurrence over (key, pos), from 4 on.

    ``tokens`` is the long form (key, pos, token) from ``explode_tokens``, or
    its summed form (key, pos, token, n) from ``count_tokens``.
    """
    firsts = _firsts(tokens, key)
    ranked = global_rank(firsts, ["first_doc", "first_pos"], name="id", start=len(SPECIAL_TOKENS))
    words = ranked.select("token", "id", F.col("n").cast("bigint"), "first_doc", "first_pos")
    return special_tokens(tokens.sparkSession).unionByName(words)


def vocab_delta(known: DataFrame, next_id: int, tokens: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """What a batch of tokens changes of a vocabulary that has the tokens
    ``known``: the new words (token, id, first_doc, first_pos), numbered from
    ``next_id`` in the order of their first occurrence, and the occurrences
    (token, n) of all words of the batch."""
    firsts = _firsts(tokens, key)
    return new_words(known, next_id, firsts), firsts.select("token", "n")


ONE_TASK = 1 << 20  # words of a batch that one task numbers and a broadcast takes


def new_words(known: DataFrame, next_id: int, firsts: DataFrame) -> DataFrame:
    """(token, id, first_doc, first_pos) of the words of first_places that are not
    among ``known``, numbered from ``next_id`` in the order of their places.
    ``firsts`` is a stored table."""
    order = ["first_doc", "first_pos"]
    small = firsts.count() <= ONE_TASK
    side = F.broadcast if small else lambda df: df
    # Known words are read where they lie: a small batch is broadcast to them.
    old = known.select("token").join(side(firsts.select("token")), "token", "left_semi")
    new = firsts.join(side(old), "token", "left_anti").select("token", *order)
    if small:
        # Few words need no ranges: one task sorts them, and its row numbers are ranks.
        ranked = new.repartition(1).sortWithinPartitions(*order)
        ranked = ranked.withColumn("id", F.monotonically_increasing_id() + F.lit(next_id).cast("bigint"))
    else:
        ranked = global_rank(new, order, name="id", start=next_id)
    return ranked.select("token", "id", *order)


def grow_vocab(vocab: DataFrame, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add a batch: known tokens keep their ids and first positions and add
    the batch's occurrences to n; new ones get the next ids in order of first
    occurrence within the batch. (streaming/vocab_stream.py keeps a vocabulary
    as a log of such changes, without rewriting it.)"""
    # One scalar reaches the driver: the next free id.
    last = vocab.agg(F.max("id")).first()[0]
    words, counts = vocab_delta(vocab, len(SPECIAL_TOKENS) if last is None else last + 1, tokens, key)
    every = vocab.select("token", "id", "n", "first_doc", "first_pos").unionByName(
        words.select("token", "id", F.lit(0).cast("bigint").alias("n"), "first_doc", "first_pos")
    )
    added = every.join(counts.withColumnRenamed("n", "_bn"), "token", "left")
    return added.select("token", "id", (F.col("n") + F.coalesce("_bn", F.lit(0))).cast("bigint").alias("n"), "first_doc", "first_pos")


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"))


def token_counts(seqs: DataFrame, key: str = "seq_id", ids: str = "ids") -> DataFrame:
    """Occurrences of each token id per sequence: (key, token_id, count)."""
    return (
        seqs.select(key, F.explode(ids).alias("token_id"))
        .groupBy(key, "token_id")
        .agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    )


def special_token_usage(seqs: DataFrame, key: str = "seq_id", ids: str = "ids") -> DataFrame:
    """(token, id, occurrences, sequences) of the four special tokens in encoded
    sequences: how often each stands, and in how many of them."""
    used = token_counts(seqs, key, ids).where(F.col("token_id") < len(SPECIAL_TOKENS))
    used = used.groupBy(F.col("token_id").alias("id")).agg(
        F.sum("count").alias("occurrences"), F.count_distinct(key).alias("sequences")
    )
    zero = F.lit(0).cast("bigint")
    return special_tokens(seqs.sparkSession).join(used, "id", "left").select(
        "token", "id", F.coalesce("occurrences", zero).alias("occurrences"), F.coalesce("sequences", zero).alias("sequences")
    )
