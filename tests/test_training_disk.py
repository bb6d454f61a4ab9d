"""Training keeps one state on disk, however many steps it takes."""

import os

from conftest import docs_df, seqs_df

from wordmill.operators import gradients as gr
from wordmill.operators.params import ModelShape, init_params
from wordmill.plans import train as tr


def test_states_of_earlier_steps_are_removed(spark, monkeypatch):
    shape, given, plain = ModelShape(20, 8, 16, 1), [], tr.train_batch
    monkeypatch.setattr(tr, "train_batch", lambda state, *rest: given.append(state) or plain(state, *rest))
    cfg = tr.TrainingConfig(learning_rate=0.01, batch_size=4, max_seq_len=3, dropout=False)
    start = gr.adam_state(init_params(spark, shape, 1))
    state, losses, steps = tr.train(start, seqs_df(spark, [[2, 5, 7, 9, 3], [2, 11, 3, 8, 4]]), shape, cfg, 1)
    place = lambda df: df._jdf.logicalPlan().rdd().getCheckpointFile().get().removeprefix("file:")
    assert steps == len(given) == 2 and not any(os.path.exists(place(s)) for s in given)
    assert os.path.exists(place(state)) and state.count() == start.count() and losses.first().batches == 2


def test_the_corpus_is_encoded_into_one_table(spark, monkeypatch):
    gone, cut = [], []
    monkeypatch.setattr(tr, "remove_folder", lambda spark, path: gone.append(path))
    plain = tr.cut_lineage
    monkeypatch.setattr(tr, "cut_lineage", lambda df: cut.append(df.columns) or plain(df))
    docs = docs_df(spark, ["the cat sat on the mat", "a dog ran far away"])
    cfg = tr.TrainingConfig(learning_rate=0.05, batch_size=64, samples_per_epoch=4)
    state, vocab, shape, losses = tr.train_from_corpus(docs, dict(embed_size=8, hidden_size=8, num_layers=1), cfg, 1)
    assert len(gone) == 1 and os.path.isdir(f"{gone[0]}/lookup".removeprefix("file:"))
    assert not any("ids" in columns for columns in cut) and losses.first().batches == 1
