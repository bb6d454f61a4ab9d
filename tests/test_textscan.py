"""Words and look-ups on Arrow batches against the pattern and plain Python."""

import pyarrow as pa
from pyspark.sql import functions as F

from wordmill.operators import textscan
from wordmill.operators import tokens as tk
from wordmill.operators import vocab as vc

TEXTS = ["Hello, world!", "", None, "a_b c\x0bd\te\ff\r\ng  h", "ΣΑΣ İstanbul Kelvin naïve 漢字 x😀😀y", "...", " \n ", "end", "the the the"]


def test_words_equal_the_pattern(spark):
    docs = spark.createDataFrame([(i % 5 if i else None, t) for i, t in enumerate(TEXTS * 3)], "doc_id bigint, text string").coalesce(2)
    plain, summed = tk.explode_tokens(docs), tk.count_tokens(docs)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(vc.build_vocab(plain)) == rows(vc.build_vocab(summed))
    counts = tk.word_counts(docs, out="n")
    assert rows(counts) == rows(docs.select("doc_id", F.coalesce(F.size(tk.split_words_expr(F.col("text"))), F.lit(-1)).cast("bigint").alias("n")))


def test_slices_bound_what_is_worked_at_a_time():
    assert list(textscan.slices([3, 1, 9, 0, 2], 4)) == [(0, 2), (2, 3), (3, 5)]
    assert list(textscan.slices([], 4)) == []


def test_misses_are_filled_in_their_order():
    lists = pa.array([[5, 7, 5], None, [9], []], pa.list_(pa.int64()))
    near, rest = textscan.look_up([3, 0, 1, 0], lists.flatten(), pa.array([7], pa.int64()), pa.array(["seven"]))
    assert near.to_pylist() == [[None, "seven", None], [], [None], []]
    assert rest.to_pylist() == [[{"pos": 0, "item": 5}, {"pos": 2, "item": 5}], [], [{"pos": 0, "item": 9}], []]
    far = pa.array([["a", "b"], [], [None], []], pa.list_(pa.string()))
    assert textscan.fill(near, far).to_pylist() == [["a", "seven", "b"], [], [None], []]


def test_the_look_up_stores_no_long_form(spark, monkeypatch):
    """A stored row is a text with its ids, not a sort of one row per token."""
    from wordmill.operators import _util

    docs = spark.createDataFrame([(1, "b a b"), (1, "c")], "doc_id bigint, text string")
    vocab = vc.build_vocab(tk.count_tokens(docs)).cache()
    plans, plain = [], _util.stored
    monkeypatch.setattr(_util, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    assert sorted(r["ids"] for r in tk.encode(docs, vocab).collect())
    assert "ObjectHashAggregate" not in plans[0] and "Generate" not in plans[0]
