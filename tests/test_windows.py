from conftest import seqs_df
from pyspark.sql import functions as F

from wordmill.operators import windows as wn


def pairs(df):
    return [(r["input"], r["target"]) for r in df.orderBy("seq_id", "i").collect()]


def test_windows_contract(spark):
    assert pairs(wn.next_token_windows(seqs_df(spark, [[1, 2, 3, 4, 5]]), 3)) == [
        ([1], 2), ([1, 2], 3), ([1, 2, 3], 4), ([2, 3, 4], 5)
    ]
    assert pairs(wn.next_token_windows(seqs_df(spark, [[1, 2]]), 10)) == [([1], 2)]
    assert pairs(wn.next_token_windows(seqs_df(spark, [[1], []]), 10)) == []


def test_window_count_and_no_exchange(spark):
    seqs = seqs_df(spark, [list(range(n)) for n in [0, 1, 2, 7, 30]])
    w = wn.next_token_windows(seqs, 10)
    assert w.count() == sum(max(n - 1, 0) for n in [0, 1, 2, 7, 30])
    assert "Exchange" not in w._jdf.queryExecution().executedPlan().toString()


def test_training_plan(spark):
    assert wn.plan_values(2000, 0.001, 64, 2) == {"max_seq_len": 10, "samples_per_epoch": 100, "batch_size": 32, "n_batches": 4}
    assert wn.plan_values(2000, 0.03, 64, 2)["max_seq_len"] == 8
    assert wn.plan_values(2000, 0.05, 64, 2) == {"max_seq_len": 5, "samples_per_epoch": 40, "batch_size": 32, "n_batches": 2}
    assert wn.plan_values(10, 0.001, 64, 2)["n_batches"] == 0
    df = wn.training_plan(spark.createDataFrame([(2000,)], "n_tokens bigint"), 0.001, 64, 2).first()
    assert (df["samples_per_epoch"], df["batch_size"], df["n_batches"]) == (100, 32, 4)


def test_sample_windows_partition_independent(spark):
    seqs = seqs_df(spark, [list(range(100 + n, 100 + n + 3 * n)) for n in range(1, 40)])
    a = wn.sample_windows(seqs.repartition(1), 200, 5, seed=3, epoch=1)
    b = wn.sample_windows(seqs.repartition(16), 200, 5, seed=3, epoch=1)
    key = lambda df: sorted((r["sample_no"], r["seq_id"], r["i"], tuple(r["input"]), r["target"]) for r in df.collect())
    ka = key(a)
    assert len(ka) == 200 and ka == key(b)
    for s, sid, i, inp, tgt in ka:
        assert tgt == inp[-1] + 1 and len(inp) == min(i + 1, 5)


def test_batches(spark):
    s = spark.range(70).withColumnRenamed("id", "sample_no")
    out = wn.chunk_batches(s, 32, 4, 70).orderBy("sample_no").collect()
    assert [r["batch"] for r in out][:33][-2:] == [0, 1]
    assert out[7]["worker"] == 0 and out[8]["worker"] == 1 and out[31]["worker"] == 3
    assert [r["worker"] for r in out if r["batch"] == 2] == [0, 1, 2, 3, 3, 3]
    b = wn.assign_batches(s, 32).orderBy("sample_no").collect()
    assert b[64]["batch"] == 2


def test_chunked_windows_equal_narrow(spark):
    seqs = seqs_df(spark, [list(range(n)) for n in [0, 1, 2, 3, 7, 30, 101]])
    key = lambda df: sorted((r["seq_id"], r["i"], tuple(r["input"]), r["target"]) for r in df.collect())
    narrow = key(wn.next_token_windows(seqs, 4))
    for c in (1, 3, 16, 1000):
        assert key(wn.next_token_windows(seqs, 4, chunk=c)) == narrow


def test_global_prefix_sum_matches_window(spark):
    from pyspark.sql import Window

    from wordmill.operators._util import global_prefix_sum

    df = spark.range(3000).select(F.col("id").alias("k"), ((F.col("id") * 37) % 11).alias("c")).repartition(11)
    got = {r["k"]: r["off"] for r in global_prefix_sum(df, ["k"], "c", "off").collect()}
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    exp = {r["k"]: r["off"] for r in df.select("k", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("off")).collect()}
    assert got == exp
