import math

import numpy as np
import pytest
from conftest import seqs_df
from pyspark.sql import functions as F

from wordmill.operators import gradients as gr
from wordmill.operators.params import ModelShape, collect_weights, init_params
from wordmill.operators.scoring import broadcast_model
from wordmill.plans.train import TrainingConfig, train, train_batch

SHAPE = ModelShape(vocab_size=20, embed_size=8, hidden_size=16, num_layers=1)


def batch_df(spark, inputs, targets):
    return spark.createDataFrame(
        [(i, list(x), t) for i, (x, t) in enumerate(zip(inputs, targets))], "sample_no bigint, input array<bigint>, target bigint"
    )


def numpy_grads(w, shape, inputs, targets):
    from wordmill.operators.model import hidden_states, pad_ids

    V, D = shape.vocab_size, shape.embed_size
    out, emb = np.zeros((V, D)), np.zeros((V, D))
    for x, t in zip(inputs, targets):
        ids, _ = pad_ids([x])
        h = hidden_states(w, shape, ids)[0, len(x) - 1]
        lg = h @ w["output_layer"].T
        p = np.exp(lg - lg.max())
        p /= p.sum()
        p[t] -= 1
        out += np.outer(p, h)
        emb[x[-1]] += p @ w["output_layer"]
    return out, emb


def test_window_gradients_match_numpy(spark):
    params = init_params(spark, SHAPE, 1).cache()
    w = collect_weights(params, SHAPE)
    inputs, targets = [[1, 2, 3], [4, 5, 6], [1, 2]], [4, 7, 3]
    model = broadcast_model(params, SHAPE)
    raw = gr.window_gradients(batch_df(spark, inputs, targets).repartition(2), model, SHAPE, training=False)
    summed = {(r["param"], r["row_id"]): np.array(r["vec"]) for r in gr.sum_gradients(raw).collect()}
    out, emb = numpy_grads(w, SHAPE, inputs, targets)
    for v in range(20):
        np.testing.assert_allclose(summed[("output_layer", v)], out[v], rtol=1e-9, atol=1e-12)
    for t in (3, 6, 2):
        np.testing.assert_allclose(summed[("embedding", t)], emb[t], rtol=1e-9, atol=1e-12)
    loss, n = summed[(gr.LOSS_PARAM, 0)]
    assert n == 3 and loss > 0


def test_sum_forms_agree(spark):
    g = spark.createDataFrame([("a", 1, [1.0, 2.0]), ("a", 1, [3.0, 4.0]), ("b", 2, [1.0, 1.0])], gr.GRADS_SCHEMA)
    a = {(r["param"], r["row_id"]): r["vec"] for r in gr.sum_gradients(g).collect()}
    b = {(r["param"], r["row_id"]): r["vec"] for r in gr.sum_gradients_long(g).collect()}
    assert a == b == {("a", 1): [4.0, 6.0], ("b", 2): [1.0, 1.0]}


def test_clip_and_scale(spark):
    g = spark.createDataFrame([("embedding", 0, [3.0, 0.0]), ("output_layer", 1, [0.0, 4.0]), ("x", 0, [9.0, 9.0])], gr.GRADS_SCHEMA)
    clipped, norm = gr.clip_gradients(g, 1.0)
    assert norm == 5.0
    got = {r["param"]: r["vec"] for r in clipped.collect()}
    assert got["embedding"] == pytest.approx([0.6, 0.0]) and got["x"] == [9.0, 9.0]


def test_adam_two_steps_match_numpy(spark):
    cfg = gr.AdamConfig()
    st = gr.adam_state(spark.createDataFrame([("embedding", 0, [0.5, -0.2]), ("frozen", 0, [1.0, 1.0])], gr.GRADS_SCHEMA))
    g = spark.createDataFrame([("embedding", 0, [0.1, -0.3])], gr.GRADS_SCHEMA)
    s1 = gr.adam_step(st, g, 1, cfg, ["embedding"])
    s2 = gr.adam_step(s1, g.where("false"), 2, cfg, ["embedding"])
    w, m, v = np.array([0.5, -0.2]), np.zeros(2), np.zeros(2)
    for t, grad in ((1, np.array([0.1, -0.3])), (2, np.zeros(2))):
        grad = grad + cfg.weight_decay * w
        m = cfg.beta1 * m + (1 - cfg.beta1) * grad
        v = cfg.beta2 * v + (1 - cfg.beta2) * grad * grad
        step = cfg.learning_rate * math.sqrt(1 - cfg.beta2**t) / (1 - cfg.beta1**t)
        w = np.clip(w - step * m / (np.sqrt(v) + cfg.epsilon), -10, 10)
    rows = {r["param"]: r for r in s2.collect()}
    np.testing.assert_allclose(rows["embedding"]["vec"], w, rtol=1e-12)
    assert rows["frozen"]["vec"] == [1.0, 1.0]


def test_lr_schedules(spark):
    t = spark.range(4).select(F.col("id").alias("t"))
    e = [r[0] for r in t.select(gr.effective_lr(0.001, F.col("t"))).collect()]
    assert e[0] == 0.001 and e[1] == pytest.approx(0.001 * math.sqrt(0.001) / 0.1)
    wu = [r[0] for r in t.select(gr.warmup_lr(0.001, F.col("t"), 2)).collect()]
    assert wu == [0.001, 0.0005, 0.0005, 0.0005]
    wu = [r[0] for r in spark.range(6).select(gr.warmup_lr(1.0, F.col("id"), 4)).collect()]
    assert wu == [1.0, 0.25, 0.5, 0.75, 0.75, 0.75]


def test_train_errors_and_noop(spark):
    params = gr.adam_state(init_params(spark, SHAPE, 1))
    with pytest.raises(ValueError):
        train(params, seqs_df(spark, [[2]]), SHAPE, TrainingConfig(workers=2), 1)
    state, losses, steps = train(params, seqs_df(spark, [[1, 2, 3]]), SHAPE, TrainingConfig(workers=2), 0)
    assert steps == 0 and losses.count() == 0


def test_train_batch_moves_only_updated_params(spark):
    params = gr.adam_state(init_params(spark, SHAPE, 1)).cache()
    batch = batch_df(spark, [[1, 2, 3], [4, 5, 6], [1, 2]], [4, 7, 3])
    new, loss, norm = train_batch(params, batch, SHAPE, TrainingConfig(workers=2, dropout=False), 1)
    assert loss > 0 and norm > 0
    old = {(r["param"], r["row_id"]): r["vec"] for r in params.collect()}
    changed = {r["param"] for r in new.collect() if r["vec"] != old[(r["param"], r["row_id"])]}
    # final beta starts at 0 and gets no gradient, so weight decay leaves it at 0
    assert changed == set(gr.updated_params(SHAPE)) - {"final_ln_beta"}
    assert "transformer_0_attn_query" not in changed


@pytest.mark.parametrize("rate", [0.001, 0.03, 0.05])
def test_train_takes_every_window_once_per_epoch(spark, rate):
    """Epochs of one batch equal plain steps on all windows; smaller batches
    cover the same windows."""
    from wordmill.operators.windows import all_windows, next_token_windows

    seqs = seqs_df(spark, [[2, 5, 7, 9, 3], [2, 11, 3], [2, 3]])
    state = gr.adam_state(init_params(spark, SHAPE, seed=3)).cache()
    cfg = TrainingConfig(learning_rate=rate, batch_size=16, max_seq_len=4, dropout=False)
    got, losses, steps = train(state, seqs, SHAPE, cfg, 2)
    want, means = state, []
    batch = next_token_windows(seqs, 4).withColumn("sample_no", F.col("seq_id") * 10 + F.col("i")).cache()
    for t in (1, 2):
        want, loss, _ = train_batch(want, batch, SHAPE, cfg, t)
        means.append(loss)
    assert steps == 2
    assert [r["mean_loss"] for r in losses.orderBy("epoch").collect()] == pytest.approx(means, rel=1e-9)
    a, b = ({(r["param"], r["row_id"]): r["vec"] for r in s.select("param", "row_id", "vec").collect()} for s in (got, want))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-6, abs=1e-9) for k in a)
    numbered = all_windows(seqs, 4, seed=1, epoch=1)
    assert sorted(r["sample_no"] for r in numbered.collect()) == list(range(7))
    assert numbered.drop("sample_no").exceptAll(batch.drop("sample_no")).count() == 0
    if rate == 0.05:
        small = TrainingConfig(learning_rate=rate, batch_size=3, samples_per_epoch=8, max_seq_len=4, dropout=False)
        assert train(state, seqs, SHAPE, small, 1)[2] == 3


def test_train_from_corpus_equals_numpy(spark, tmp_path):
    """Vocabulary, windows, two steps and the saved model, worked out plainly."""
    from conftest import docs_df

    from wordmill.plans.train import train_from_corpus
    from wordmill.sources.store import load_model, read_vocab

    texts = ["the cat sat on the mat", "a cat ran", "the end"]
    sizes = {"embed_size": 8, "hidden_size": 16, "num_layers": 1}
    cfg = TrainingConfig(learning_rate=0.05, batch_size=100, max_seq_len=4, dropout=False, seed=6)
    _, _, shape, losses = train_from_corpus(docs_df(spark, texts), sizes, cfg, 2, str(tmp_path))

    vocab, seqs = {}, []
    for t in texts:
        seqs.append([2, *(vocab.setdefault(w, 4 + len(vocab)) for w in t.split()), 3])
    assert {r.token: r.id for r in read_vocab(spark, f"{tmp_path}/vocab").where("id > 3").collect()} == vocab
    assert shape.vocab_size == 4 + len(vocab)
    pairs = [(s[max(0, i - 3) : i + 1], s[i + 1]) for s in seqs for i in range(len(s) - 1)]
    w = collect_weights(init_params(spark, shape, 6), shape)
    names = gr.updated_params(shape)
    m, v = ({n: np.zeros_like(w[n]) for n in names} for _ in range(2))
    means = []
    for t in (1, 2):
        out, emb = numpy_grads(w, shape, [p[0] for p in pairs], [p[1] for p in pairs])
        means.append(np.mean([loss_of(w, shape, *p) for p in pairs]))
        norm = np.sqrt((out**2).sum() + (emb**2).sum()) / len(pairs)
        f = min(1.0, 1.0 / norm) / len(pairs)
        step = 0.05 * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for n in names:
            g = {"output_layer": out, "embedding": emb}.get(n, np.zeros_like(w[n])) * f + 0.01 * w[n]
            m[n], v[n] = 0.9 * m[n] + 0.1 * g, 0.999 * v[n] + 0.001 * g * g
            w[n] = np.clip(w[n] - step * m[n] / (np.sqrt(v[n]) + 1e-8), -10, 10)
    assert [r.mean_loss for r in losses.orderBy("epoch").collect()] == pytest.approx(means, rel=1e-9)
    state, again, steps = load_model(spark, f"{tmp_path}/params")
    assert again == shape and steps == 2
    saved = collect_weights(state, shape)
    for n in w:
        np.testing.assert_allclose(saved[n], w[n], rtol=1e-7, atol=1e-9)


def loss_of(w, shape, ids, target):
    from wordmill.operators.model import hidden_states

    logits = hidden_states(w, shape, np.array([ids]))[0, -1] @ w["output_layer"].T
    p = np.exp(logits - logits.max())
    return -math.log(p[target] / p.sum() + 1e-10)
