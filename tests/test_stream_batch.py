"""What one micro-batch of the vocabulary stream costs, and both ways to number its words."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import docs_df

from wordmill.operators import tokens as tk
from wordmill.operators import vocab as vc
from wordmill.operators.textscan import first_places

FIELDS = ("token", "id", "n", "first_doc", "first_pos")


def rows(df):
    return sorted(tuple(r) for r in df.select(*FIELDS).collect())


def test_a_batch_takes_few_jobs(spark, tmp_path):
    from wordmill.streaming.vocab_stream import latest_vocab, vocab_batch_writer

    docs = docs_df(spark, [f"the cat number{i} sat on the mat{i // 2}" for i in range(9)])
    write = vocab_batch_writer(str(tmp_path))
    write(docs.where("doc_id < 3"), 0)
    sc = spark.sparkContext
    sc.setJobGroup("one batch", "")
    try:
        write(docs.where("doc_id >= 3"), 1)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("one batch")) <= 16
    assert rows(latest_vocab(spark, str(tmp_path))) == rows(vc.build_vocab(tk.explode_tokens(docs)))


@pytest.mark.parametrize("one_task", (0, 1 << 20))
def test_new_words_are_numbered_by_place(spark, monkeypatch, tmp_path, one_task):
    monkeypatch.setattr(vc, "ONE_TASK", one_task)
    docs = docs_df(spark, ["b a b", "d, c", "a e"])
    vc.first_places(tk.explode_tokens(docs)).write.parquet(str(tmp_path / "f"))
    known = spark.createDataFrame([("a",), ("zz",)], "token string")
    got = vc.new_words(known, 7, spark.read.parquet(str(tmp_path / "f")))
    assert sorted((r.id, r.token) for r in got.collect()) == [(7, "b"), (8, "d"), (9, ","), (10, "c"), (11, "e")]


@pytest.mark.parametrize("keys", ([0, 1, 2, 3], [3, 0, 2, 1], [2, None, 0, 1], [1, 1, 0, None]))
def test_first_places_for_keys_in_any_order(keys):
    texts = [["a", "b", "a"], [], ["b", "c"], ["c", "a", "d", "b"]]
    words = pa.array([w for t in texts for w in t], pa.large_string())
    got = first_places(pa.array(keys, pa.int64()), np.array([len(t) for t in texts]), words).to_pylist()
    places = [(k is not None, k or 0, pos, w) for k, t in zip(keys, texts, strict=True) for pos, w in enumerate(t)]
    for r in got:
        mine = [p[:3] for p in places if p[3] == r["token"]]
        assert (r["key"] is not None, r["key"] or 0, r["pos"]) == min(mine) and r["n"] == len(mine)
    assert {r["token"] for r in got} == {"a", "b", "c", "d"}
