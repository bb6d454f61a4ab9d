import os
import tempfile

from conftest import SF, docs_df

from wordmill.operators import tokens as tk
from wordmill.operators import vocab as vc
from wordmill.sources.clean import clean_articles, structural_audit
from wordmill.streaming.vocab_stream import stream_vocab, write_in_order


def test_stream_vocab_equals_build(spark):
    texts = ["the cat sat", "the dog ran far", "a cat and a dog", "far far away", "new words here", "and the end"]
    docs = docs_df(spark, texts)
    base = tempfile.mkdtemp(prefix="wm-stream-")
    write_in_order(docs, f"{base}/src", 3)
    got = stream_vocab(spark, f"{base}/src", f"{base}/vocab", f"{base}/ckpt")
    full = vc.build_vocab(tk.explode_tokens(docs))
    key = lambda df: sorted(tuple(r) for r in df.select("token", "id", "n", "first_doc", "first_pos").collect())
    assert key(got) == key(full)


def test_clean_rules(spark):
    pages = spark.createDataFrame(
        [
            (0, "<html><script>x()</script><p>Real prose here.</p><nav>menu</nav><!-- c --><p>A &amp; B</p></html>"),
            (1, "#REDIRECT [[Other]]"),
            (2, "Mercury (disambiguation) may refer to:"),
            (3, "Text with [[link|label]] and [[plain]] {{cite}}<ref>note</ref>.\n| a | b |\n* item\n== Head ==\nSee also x"),
        ],
        "doc_id bigint, text string",
    )
    out = {r["doc_id"]: r["text"] for r in clean_articles(pages, html=True).collect()}
    assert out == {0: "Real prose here.\nA & B", 3: "Text with label and plain ."}


def test_structural_audit(spark):
    df = spark.createDataFrame([(0, "\n".join(["| a | b |"] * 6 + ["== h =="]))], "doc_id bigint, text string")
    r = structural_audit(df).first()
    assert (r["table_lines"], r["header_lines"], r["warn"]) == (6, 1, True)


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 4 and set(df.columns) == {"token", "id", "n", "first_doc", "first_pos"}
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90
    assert os.path.isdir(SF)


def test_stream_batch_replay_is_idempotent(spark):
    from wordmill.streaming.vocab_stream import latest_vocab, vocab_batch_writer

    texts = ["the cat sat", "the dog ran far", "a cat and a dog", "far far away"]
    docs = docs_df(spark, texts)
    d = tempfile.mkdtemp(prefix="wm-replay-") + "/vocab"
    write = vocab_batch_writer(d)
    b0, b1 = docs.where("doc_id < 2"), docs.where("doc_id >= 2")
    write(b0, 0)
    write(b1, 1)
    write(b1, 1)  # a replayed micro-batch recomputes from version 0 and overwrites version 1
    write(b0, 0)  # replaying an older batch rewrites its own version only
    key = lambda df: sorted(tuple(r) for r in df.select("token", "id", "n", "first_doc", "first_pos").collect())
    assert key(latest_vocab(spark, d)) == key(vc.build_vocab(tk.explode_tokens(docs)))


def test_write_in_order_takes_null_keys_and_empty_tables(spark, tmp_path):
    from wordmill.streaming.vocab_stream import write_in_order

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id bigint, text string")
    for name, table in (("some", rows), ("none", rows.limit(0))):
        paths = write_in_order(table, str(tmp_path / name), 2)
        assert sum(spark.read.schema(rows.schema).parquet(p).count() for p in paths) == table.count()


def test_a_batch_writes_its_new_words_only_and_compaction_changes_nothing(spark):
    from wordmill.streaming.vocab_stream import VocabLog, latest_vocab, vocab_batch_writer

    texts = [f"the cat number{i} sat on the mat{i // 2}" for i in range(10)]
    docs = docs_df(spark, texts)
    key = lambda df: sorted(tuple(r) for r in df.select("token", "id", "n", "first_doc", "first_pos").collect())
    want = key(vc.build_vocab(tk.explode_tokens(docs)))
    for every in (1, 3, 100):
        d = tempfile.mkdtemp(prefix="wm-log-") + "/vocab"
        write = vocab_batch_writer(d, compact_every=every)
        for b in range(5):
            write(docs.where(f"doc_id div 2 = {b}"), b)
        assert key(latest_vocab(spark, d)) == want
        fresh = [r.token for r in spark.read.parquet(f"{d}/words/batch=3").collect()]
        assert sorted(fresh) == ["mat3", "number6", "number7"]
        log = VocabLog(spark, d)
        assert log.base == {1: 4, 3: 2, 100: None}[every] and len(log.after) == {1: 0, 3: 2, 100: 5}[every]


def test_a_crash_between_the_folders_leaves_the_log_as_it_was(spark, monkeypatch):
    from wordmill.streaming import vocab_stream as vs

    docs = docs_df(spark, ["the cat sat", "a new dog", "and the end"])
    key = lambda df: sorted(tuple(r) for r in df.select("token", "id", "n", "first_doc", "first_pos").collect())
    d = tempfile.mkdtemp(prefix="wm-crash-") + "/vocab"
    write = vs.vocab_batch_writer(d)
    write(docs.where("doc_id = 0"), 0)
    before = key(vs.latest_vocab(spark, d))
    # Words and counts of batch 1 are written, its manifest is not.
    spark.createDataFrame([("torn", 99, 1, 0)], vs.WORDS).write.parquet(f"{d}/words/batch=1")
    spark.createDataFrame([("torn", 5)], vs.COUNTS).write.parquet(f"{d}/counts/batch=1")
    assert key(vs.latest_vocab(spark, d)) == before
    write(docs.where("doc_id = 1"), 1)
    write(docs.where("doc_id = 2"), 2)
    assert key(vs.latest_vocab(spark, d)) == key(vc.build_vocab(tk.explode_tokens(docs)))
