from conftest import docs_df, seqs_df
from pyspark.sql import functions as F

from wordmill.operators import tokens as tk
from wordmill.operators import vocab as vc
from wordmill.operators._util import global_rank


def words(spark, text):
    return tk.split_words(docs_df(spark, [text])).first()["words"]


def vocab_of(spark, texts):
    return vc.build_vocab(tk.explode_tokens(docs_df(spark, texts)))


def test_split_words(spark):
    assert words(spark, "Hello World! This is a test.") == ["hello", "world", "!", "this", "is", "a", "test", "."]
    assert words(spark, "a\vb") == ["a", "\v", "b"]
    assert words(spark, "héllo 😀 don't") == ["h", "é", "llo", "😀", "don", "'", "t"]
    assert words(spark, "<PAD>") == ["<", "pad", ">"]


def test_special_tokens(spark):
    v = {r["token"]: r["id"] for r in vc.special_tokens(spark).collect()}
    assert v == {"<PAD>": 0, "<UNK>": 1, "<BOS>": 2, "<EOS>": 3}
    assert vc.vocab_size(vocab_of(spark, [""])).first()[0] == 4


def test_encode_decode(spark):
    docs = docs_df(spark, ["Hello world!", ""])
    vocab = vc.build_vocab(tk.explode_tokens(docs))
    enc = {r["doc_id"]: r["ids"] for r in tk.encode(docs, vocab).collect()}
    assert enc[0] == [2, 4, 5, 6, 3]
    assert enc[1] == [2, 3]
    dec = {r["seq_id"]: r["text"] for r in tk.decode(tk.encode(docs, vocab).withColumnRenamed("doc_id", "seq_id"), vocab).collect()}
    assert dec[0] == "hello world!"
    assert dec[1] == ""


def test_decode_punctuation_and_unknown(spark):
    vocab = vocab_of(spark, ["a , b"])
    ids = [r["id"] for r in vocab.orderBy("id").collect()]
    dec = tk.decode(seqs_df(spark, [[2] + ids[4:] + [3], [9999, 4]]), vocab).orderBy("seq_id").collect()
    assert dec[0]["text"] == "a, b"
    assert dec[1]["text"] == "<UNK> a"


def test_encode_frozen_and_lookup(spark):
    vocab = vocab_of(spark, ["hello world"])
    enc = tk.encode_frozen(docs_df(spark, ["hello there"]), vocab).first()["ids"]
    assert enc == [2, 4, 1, 3]
    toks = tk.ids_to_tokens(spark.createDataFrame([(9999,), (4,)], "token_id bigint"), vocab)
    assert {r["token_id"]: r["token"] for r in toks.collect()} == {9999: "<UNK>", 4: "hello"}


def test_encode_frozen_plan_broadcasts_vocab(spark):
    vocab = vocab_of(spark, ["hello world"])
    plan = tk.encode_frozen(docs_df(spark, ["hello there"]), vocab)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_stable_ids(spark):
    vocab = vocab_of(spark, ["Hello world! This is a test."])
    docs = docs_df(spark, ["Hello world! This is a test.", "Hello world! This is a test."])
    a, b = [r["ids"] for r in tk.encode(docs, vocab).orderBy("doc_id").collect()]
    assert a == b


def test_punctuation(spark):
    df = spark.createDataFrame([(t,) for t in [".", ",", "!", "?", ";", ":", "a", "hello", "", "ab"]], "token string")
    got = {r["token"]: r["is_punct"] for r in tk.is_punctuation(df).collect()}
    assert [got[t] for t in [".", ",", "!", "?", ";", ":"]] == [True] * 6
    assert [got[t] for t in ["a", "hello", "", "ab"]] == [False] * 4


def test_pad(spark):
    out = tk.pad_sequence(seqs_df(spark, [[1, 2, 3]]), 5).first()["padded"]
    assert out == [1, 2, 3, 0, 0]
    assert tk.pad_sequence(seqs_df(spark, [[1, 2, 3]]), 2).first()["padded"] == [1, 2]


def test_roundtrip(spark):
    docs = docs_df(spark, ["hello world", "Is it? Yes, it is."])
    vocab = vc.build_vocab(tk.explode_tokens(docs))
    assert all(r["same"] for r in tk.roundtrip_check(docs, vocab).collect())
    assert tk.roundtrip_check(docs, vocab).where("doc_id = 0").first()["decoded"] == "hello world"


def test_grow_equals_build(spark):
    texts = ["the cat sat", "the dog ran far", "a cat and a dog", "far far away"]
    full = vocab_of(spark, texts)
    docs = docs_df(spark, texts)
    v = vc.build_vocab(tk.explode_tokens(docs.where("doc_id < 2")))
    v = vc.grow_vocab(v, tk.explode_tokens(docs.where("doc_id >= 2")))
    key = lambda df: sorted((r["token"], r["id"], r["n"], r["first_doc"], r["first_pos"]) for r in df.collect())
    assert key(v) == key(full)


def test_global_rank_matches_row_number(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("a"), (F.col("id") % 3).alias("b")).distinct()
    ranked = global_rank(df.repartition(16), ["a", "b"], "r", 0)
    w = df.withColumn("r2", F.row_number().over(Window.orderBy("a", "b")) - 1)
    got = {(r["a"], r["b"]): r["r"] for r in ranked.collect()}
    exp = {(r["a"], r["b"]): r["r2"] for r in w.collect()}
    assert got == exp


def test_token_counts(spark):
    out = vc.token_counts(seqs_df(spark, [[5, 5, 6]]))
    assert {r["token_id"]: r["count"] for r in out.collect()} == {5: 2, 6: 1}


def test_encode_shuffles_text_once(spark, monkeypatch):
    from wordmill.operators import _util
    from wordmill.session import cut_lineage

    docs = docs_df(spark, ["hello world", "more words here", "hello again"])
    vocab = cut_lineage(vocab_of(spark, ["hello world", "more words here", "hello again"]))
    plans = []
    plain = _util.stored
    monkeypatch.setattr(
        _util, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name)
    )
    after = tk.encode(docs, vocab)._jdf.queryExecution().executedPlan().toString()
    # one hash exchange of the text by row; the look-up of frequent words is a
    # broadcast and the regrouping reuses the partitioning; no text comes after
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert "regexp_extract_all" in plans[0] and "regexp_extract_all" not in after


def test_build_vocab_partition_independent(spark):
    texts = ["the cat sat on the mat", "a dog ran", "the end, the cat!", "", "more cats and dogs"] * 7
    docs = docs_df(spark, texts)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = key(vc.build_vocab(tk.explode_tokens(docs.repartition(1))))
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        many = key(vc.build_vocab(tk.explode_tokens(docs.repartition(13))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_build_vocab_orders_any_key(spark):
    """Negative and 64-bit keys, and a null one, which comes first."""
    texts = [(-5, "b a"), (2**40, "a c"), (7, "c d b"), (2**63 - 1, "top a"), (-(2**63), "low b"), (None, "n d n")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    v = {r["token"]: (r["id"], r["n"], r["first_doc"], r["first_pos"]) for r in vc.build_vocab(tk.explode_tokens(docs)).collect()}
    assert v["n"] == (4, 2, None, 0) and v["d"] == (5, 2, None, 1)
    assert v["low"] == (6, 1, -(2**63), 0) and v["b"] == (7, 3, -(2**63), 1) and v["a"] == (8, 3, -5, 1)
    assert v["c"] == (9, 2, 7, 0) and v["top"] == (10, 1, 2**63 - 1, 0)


def test_rare_words_by_shuffle_match_the_broadcast(spark, monkeypatch):
    """Whatever the share of words that is broadcast, and without any."""
    from wordmill.operators import _util
    from wordmill.session import cut_lineage

    texts = ["Hello world! This is a test.", "another test, with words", "", "hello again world", None]
    docs = docs_df(spark, texts)
    vocab = cut_lineage(vocab_of(spark, texts[:4]))
    key = lambda df, k: sorted((r[k], tuple(r["ids"]) if "ids" in r else r["text"]) for r in df.collect())
    long = lambda: tk.encode(docs, vocab).select("doc_id", F.explode("ids").alias("token_id"))
    seen = []
    for hot in (100_000, 3, 0):
        monkeypatch.setattr(_util, "HOT_KEYS", hot)
        enc = tk.encode(docs, vocab)
        dec = tk.decode(enc.withColumnRenamed("doc_id", "seq_id"), vocab)
        words = sorted((r.doc_id, r.token_id, r.token) for r in tk.ids_to_tokens(long(), vocab).collect())
        seen.append((key(enc, "doc_id"), key(dec, "seq_id"), words))
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][1][0] == (0, "hello world! this is a test.")


def test_rows_that_share_a_key_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "c"), (1, "a b"), (2, None)], "doc_id bigint, text string")
    vocab = vocab_of(spark, ["a b c"])
    enc = tk.encode(docs, vocab)
    assert sorted((r.doc_id, tuple(r.ids)) for r in enc.collect()) == [(1, (2, 4, 5, 3)), (1, (2, 4, 5, 3)), (1, (2, 6, 3)), (2, (2, 3))]
    dec = tk.decode(enc.withColumnRenamed("doc_id", "seq_id"), vocab)
    assert sorted((r.seq_id, r.text) for r in dec.collect()) == [(1, "a b"), (1, "a b"), (1, "c"), (2, "")]
    check = tk.roundtrip_check(docs, vocab).collect()
    assert len(check) == 4 and sorted((r.doc_id, r.same) for r in check if r.same is not None) == [(1, True)] * 3


def test_a_hot_word_is_not_shuffled(spark, monkeypatch):
    """A word that makes up most of the corpus stays with its texts; the rows
    that cross the cold join are distinct (text, word) pairs."""
    from wordmill.operators import _util

    monkeypatch.setattr(_util, "HOT_KEYS", 1)
    docs = docs_df(spark, ["the " * 500 + f"word{i} word{i} word{i % 3}x" for i in range(20)])
    vocab = vc.build_vocab(tk.explode_tokens(docs))
    tables = []
    plain = _util.stored
    monkeypatch.setattr(_util, "stored", lambda df, name: tables.append(plain(df, name)) or tables[-1])
    enc = {r.doc_id: r.ids for r in tk.encode(docs, vocab).collect()}
    ids = {r.token: r.id for r in vocab.collect()}
    assert all(len(v) == 505 and v[1:501] == [ids["the"]] * 500 and v[501:503] == [ids[f"word{i}"]] * 2 for i, v in enc.items())
    rest = tables[0].select(F.explode("_rest").alias("x")).select("x.*")
    assert rest.where("token = 'the'").count() == 0 and rest.count() == 60
