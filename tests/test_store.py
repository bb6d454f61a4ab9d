import os
import tempfile

from pyspark.sql import functions as F

from wordmill.operators.params import ModelShape, init_params
from conftest import sample_corpus
from wordmill.sources.corpus import read_corpus
from wordmill.sources.store import read_params, read_vocab, write_params, write_vocab
from wordmill.operators import tokens as tk
from wordmill.operators import vocab as vc

SHAPE = ModelShape(vocab_size=12, embed_size=4, hidden_size=8, num_layers=1)


def test_read_params_keeps_initial_for_bad_tensors(spark):
    init = init_params(spark, SHAPE, seed=1).cache()
    trained = init.withColumn("vec", F.transform("vec", lambda x: x + 1.0))
    # one tensor with a wrong element count, one unknown name, one tensor missing
    broken = trained.where(F.col("param") != "final_ln_gamma").withColumn(
        "vec", F.when(F.col("param") == "transformer_0_ff_b1", F.slice("vec", 1, 3)).otherwise(F.col("vec"))
    ).unionByName(init.limit(1).withColumn("param", F.lit("not_a_tensor")))
    path = tempfile.mkdtemp(prefix="wm-params-") + "/m"
    write_params(broken, SHAPE, path)
    loaded = {(r["param"], r["row_id"]): r["vec"] for r in read_params(spark, path, SHAPE, init).collect()}
    base = {(r["param"], r["row_id"]): r["vec"] for r in init.collect()}
    assert loaded[("final_ln_gamma", 0)] == base[("final_ln_gamma", 0)]
    assert loaded[("transformer_0_ff_b1", 0)] == base[("transformer_0_ff_b1", 0)]
    assert loaded[("embedding", 3)] == [x + 1.0 for x in base[("embedding", 3)]]
    assert not any(p == "not_a_tensor" for p, _ in loaded)
    meta = spark.read.parquet(path + "/meta").first()
    assert (meta["vocab_size"], meta["embed_size"]) == (12, 4)


def test_vocab_roundtrip_parquet_and_json(spark):
    vocab = vc.build_vocab(tk.explode_tokens(sample_corpus(spark)))
    base = tempfile.mkdtemp(prefix="wm-vocab-")
    for fmt in ("parquet", "json"):
        write_vocab(vocab, f"{base}/{fmt}", fmt)
        back = read_vocab(spark, f"{base}/{fmt}", fmt)
        assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in vocab.collect())


def test_read_corpus_whole_text_files(spark):
    d = tempfile.mkdtemp(prefix="wm-text-")
    for name, text in (("a.txt", "Hello world.\n\nSecond paragraph."), ("b.txt", "Another file\nwith lines")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    df = read_corpus(spark, d, fmt="text")
    rows = sorted(r["text"] for r in df.collect())
    assert rows == ["Another file\nwith lines", "Hello world.\n\nSecond paragraph."]
    norm = sorted(r["text"] for r in tk.normalize_text(df).collect())
    assert norm == ["Another file with lines", "Hello world. Second paragraph."]
    assert df.select("doc_id").distinct().count() == 2


def test_sample_corpus_trains_vocab(spark):
    v = vc.build_vocab(tk.explode_tokens(sample_corpus(spark)))
    ids = {r["token"]: r["id"] for r in v.collect()}
    assert ids["hello"] == 4 and ids["world"] == 5 and ids["."] == 6


def test_a_saved_model_loads_by_its_own_dimensions_and_goes_on(spark):
    """Train, save, load, train on: equal to training without a break."""
    from conftest import seqs_df

    from wordmill.operators.gradients import adam_state
    from wordmill.operators.windows import next_token_windows
    from wordmill.plans.train import TrainingConfig, train_batch
    from wordmill.sources.store import load_model

    cfg = TrainingConfig(learning_rate=0.05, dropout=False)
    wins = next_token_windows(seqs_df(spark, [[2, 5, 7, 9, 3], [2, 11, 3]]), 4)
    batch = wins.withColumn("sample_no", F.col("seq_id") * 10 + F.col("i")).cache()
    one, _, _ = train_batch(adam_state(init_params(spark, SHAPE, seed=3)), batch, SHAPE, cfg, 1)
    whole, loss, _ = train_batch(one, batch, SHAPE, cfg, 2)

    path = tempfile.mkdtemp(prefix="wm-model-") + "/m"
    write_params(one, SHAPE, path, step=1)
    state, shape, step = load_model(spark, path, seed=99)
    assert shape == SHAPE and step == 1
    again, loss2, _ = train_batch(state, batch, shape, cfg, step + 1)
    assert abs(loss - loss2) < 1e-12
    rows = lambda df: {(r.param, r.row_id): (r.vec, r.m, r.v) for r in df.collect()}
    a, b = rows(whole), rows(again)
    assert a.keys() == b.keys()
    assert all(abs(x - y) < 1e-9 for k in a for u, w in zip(a[k], b[k], strict=True) for x, y in zip(u, w, strict=True))


def test_params_flatten_and_back(spark):
    from wordmill.operators.params import flatten_all, flatten_matrix, unflatten_all, unflatten_matrix

    init = init_params(spark, SHAPE, seed=1).cache()
    flat = flatten_all(init)
    shapes = init.groupBy("param").agg(F.count("*").alias("rows"), F.max(F.size("vec")).alias("cols"))
    rows = lambda df: sorted((r.param, r.row_id, tuple(r.vec)) for r in df.select("param", "row_id", "vec").collect())
    assert rows(unflatten_all(flat, shapes)) == rows(init)
    lost = flat.where("NOT (param = 'output_layer' AND k = 3)")
    assert {r.param for r in unflatten_all(lost, shapes).collect()} == {r.param for r in shapes.collect()} - {"output_layer"}
    one = flatten_matrix(init, "embedding")
    assert rows(unflatten_matrix(one, "embedding", 12, 4)) == rows(init.where("param = 'embedding'"))
    assert unflatten_matrix(one, "embedding", 12, 5).count() == 0
