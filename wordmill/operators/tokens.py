"""Tokenization: split, explode, encode, decode, pad, round trip.

Sequences are ``(key, ids ARRAY<BIGINT>)``, one row per document, prompt or
text; an array is bounded by its own source row.  Rows that share a key stay
rows of their own.  The text is hash-partitioned by row once; its words are cut
and the frequent ones looked up there, rare ones are shuffled once per text that
has them (see ``split_lookup``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    BOS_ID,
    BOS_TOKEN,
    EOS_ID,
    EOS_TOKEN,
    PAD_ID,
    PAD_TOKEN,
    UNK_ID,
    UNK_TOKEN,
    is_punctuation_expr,
    lower_runes,
    normalize_expr,
    split_words_expr,
)
from ..session import ship_package, stored
from ._util import split_join, split_lookup
from .textscan import count_words, first_places, slices, split_texts


def split_words(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    return df.withColumn(out, split_words_expr(F.col(text)))


def explode_tokens(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Long form (key, pos, token); pos counts from 0 within each text."""
    return df.select(key, F.posexplode(split_words_expr(F.col(text))).alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def is_punctuation(df: DataFrame, token: str = "token", out: str = "is_punct") -> DataFrame:
    return df.withColumn(out, is_punctuation_expr(F.col(token)))


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """explode_tokens summed where the texts are read: (key, pos, token, n), a word
    with its occurrences in some texts and the first of its places in them. What
    counts and orders words (build_vocab) takes either form."""
    lower = df.select(key, lower_runes(F.col(text)).alias("text"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for at, end in slices(size):
                table = first_places(keys.slice(at, end - at), *split_texts(texts.slice(at, end - at)))
                yield from table.rename_columns([key, "pos", "token", "n"]).to_batches()

    ship_package(df.sparkSession)
    return lower.mapInArrow(parts, f"`{key}` {df.schema[key].dataType.simpleString()}, pos bigint, token string, n bigint")


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "words") -> DataFrame:
    """(key, out): the number of words of every text, -1 for null."""
    lower = df.select(key, lower_runes(F.col(text)).alias("text"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            n = [count_words(texts.slice(at, end - at)) for at, end in slices(size)]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            n[texts.is_null().to_numpy(zero_copy_only=False)] = -1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], [key, out])

    ship_package(df.sparkSession)
    return lower.mapInArrow(counts, f"`{key}` {df.schema[key].dataType.simpleString()}, `{out}` bigint")


ROW = "__row"


def _lookup_ids(df: DataFrame, key: str, text: str, vocab: DataFrame, frozen: bool, within: str | None = None) -> DataFrame:
    # Spread by row, so that no file's texts stay with one task.
    texts = df.select(key, text).withColumn(ROW, F.monotonically_increasing_id()).repartition(ROW)
    words = texts.select(key, split_words_expr(F.col(text)).alias("_words"))
    found = split_lookup(words, key, "_words", vocab, "token", "id", "n", within)
    body = F.transform("found", lambda x: F.coalesce(x, F.lit(UNK_ID).cast("bigint"))) if frozen else F.col("found")
    return found.select(
        key, F.concat(F.array(F.lit(BOS_ID).cast("bigint")), body, F.array(F.lit(EOS_ID).cast("bigint"))).alias("ids")
    )


def encode(df: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text", within: str | None = None) -> DataFrame:
    """text -> [BOS] + ids + [EOS] with a vocabulary that covers the text
    (built or grown from it); ids are NULL for words outside it. Its scratch
    table lies below ``within``, if given."""
    return _lookup_ids(df, key, text, vocab, False, within)


def encode_frozen(df: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Same with a fixed vocabulary: unseen words become UNK (1)."""
    return _lookup_ids(df, key, text, vocab, frozen=True)


def ids_to_tokens(ids_long: DataFrame, vocab: DataFrame, id_col: str = "token_id") -> DataFrame:
    """id -> token, unknown ids -> <UNK>."""
    table = vocab.select(F.col("id").alias(id_col), F.col("token").alias("_tok"), "n")
    found = split_join(ids_long, table, id_col, "_tok", "n")
    return found.withColumn("token", F.coalesce(F.col("_tok"), F.lit(UNK_TOKEN))).drop("_tok")


def decode(seqs: DataFrame, vocab: DataFrame, key: str = "seq_id", ids: str = "ids", out: str = "text") -> DataFrame:
    """ids -> text.  BOS, EOS and PAD are skipped, unknown ids read <UNK>;
    words are joined by one space except before punctuation and before the
    first kept word."""
    # A null id is no id of the vocabulary.
    src = seqs.select(key, F.transform(ids, lambda x: F.coalesce(x, F.lit(-1).cast("bigint"))).alias("_ids"))
    found = split_lookup(src, key, "_ids", vocab, "id", "token", "n")
    words = F.transform("found", lambda x: F.coalesce(x, F.lit(UNK_TOKEN)))
    kept = F.filter(words, lambda w: ~w.isin(BOS_TOKEN, EOS_TOKEN, PAD_TOKEN))
    pieces = F.transform(
        kept,
        lambda w, i: F.concat(F.when((i > 0) & ~is_punctuation_expr(w), F.lit(" ")).otherwise(F.lit("")), w),
    )
    return found.select(key, F.array_join(pieces, "").alias(out))


def pad_expr(c: Column, n: int) -> Column:
    """Truncate to n, or right-pad with PAD."""
    return F.slice(F.concat(c, F.array_repeat(F.lit(PAD_ID).cast("bigint"), n)), 1, n) if n > 0 else F.array().cast("array<bigint>")


def pad_sequence(seqs: DataFrame, n: int, ids: str = "ids", out: str = "padded") -> DataFrame:
    return seqs.withColumn(out, pad_expr(F.col(ids), n))


def roundtrip_check(df: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """decode(encode(x)) against x rebuilt from its own words: one row per
    text with the flag ``same``.  Both sides are normalised the same way, so
    a mismatch means the ids lost or reordered a word."""
    words = split_words_expr(F.col(text))
    expected = F.array_join(
        F.transform(
            words,
            lambda w, i: F.concat(F.when((i > 0) & ~is_punctuation_expr(w), F.lit(" ")).otherwise(F.lit("")), w),
        ),
        "",
    )
    # Numbered once, so that both sides speak of the same text.
    src = stored(df.select(key, text).withColumn("__n", F.monotonically_increasing_id()), "texts")
    dec = decode(encode_frozen(src, vocab, "__n", text), vocab, "__n", "ids", "decoded")
    return src.select("__n", key, expected.alias("expected")).join(dec, "__n", "left").select(
        key, "expected", "decoded", (F.col("expected") == F.coalesce(F.col("decoded"), F.lit(""))).alias("same")
    )


def normalize_text(df: DataFrame, text: str = "text", out: str | None = None) -> DataFrame:
    return df.withColumn(out or text, normalize_expr(F.col(text)))
