import math

import pytest
from pyspark.sql import functions as F

from wordmill.operators import matrix as mx


def mat(spark, rows):
    return spark.createDataFrame(
        [(i, j, float(v)) for i, r in enumerate(rows) for j, v in enumerate(r)], "i bigint, j bigint, v double"
    )


def dense(df):
    cells = {(r["i"], r["j"]): r["v"] for r in df.collect()}
    n = max(i for i, _ in cells) + 1
    m = max(j for _, j in cells) + 1
    return [[cells.get((i, j), 0.0) for j in range(m)] for i in range(n)]


def test_multiply(spark):
    a, b = mat(spark, [[1, 2, 3], [4, 5, 6]]), mat(spark, [[7, 8], [9, 10], [11, 12]])
    assert dense(mx.matrix_multiply(a, b, (2, 3), (3, 2))) == [[58, 64], [139, 154]]
    with pytest.raises(ValueError):
        mx.matrix_multiply(a, a, (2, 3), (2, 3))


def test_add_scale_transpose_apply(spark):
    a, b = mat(spark, [[1, 2], [3, 4]]), mat(spark, [[5, 6], [7, 8]])
    assert dense(mx.matrix_add(a, b, (2, 2), (2, 2))) == [[6, 8], [10, 12]]
    assert dense(mx.matrix_scale(a, 2.5)) == [[2.5, 5], [7.5, 10]]
    assert dense(mx.matrix_transpose(mat(spark, [[1, 2, 3], [4, 5, 6]]))) == [[1, 4], [2, 5], [3, 6]]
    assert dense(mx.matrix_relu(mat(spark, [[-1, 2], [-3, 4]]))) == [[0, 2], [0, 4]]
    assert dense(mx.matrix_hadamard(a, b)) == [[5, 12], [21, 32]]
    with pytest.raises(ValueError):
        mx.matrix_add(a, b, (2, 2), (2, 3))


def test_softmax_rows(spark):
    out = dense(mx.row_softmax(mat(spark, [[1, 2, 3], [4, 5, 6]])))
    for row in out:
        assert abs(sum(row) - 1.0) < 1e-10 and all(x > 0 for x in row)


def test_layer_norm(spark):
    out = dense(mx.row_layer_norm(mat(spark, [[1, 2, 3, 4]]), 1e-6))[0]
    mu, var = 2.5, 1.25
    assert all(abs(o - (x - mu) / math.sqrt(var + 1e-6)) < 1e-12 for o, x in zip(out, [1, 2, 3, 4]))


def test_get_set_outside(spark):
    m = mx.matrix_zeros(spark, 2, 2)
    got = mx.matrix_get(m, spark.createDataFrame([(5, 5), (0, 1)], "i bigint, j bigint"))
    assert {(r["i"], r["j"]): r["v"] for r in got.collect()} == {(5, 5): 0.0, (0, 1): 0.0}
    upd = spark.createDataFrame([(0, 1, 7.0), (9, 9, 1.0)], "i bigint, j bigint, v double")
    assert dense(mx.matrix_set(m, upd)) == [[0, 7], [0, 0]]


def test_activations(spark):
    df = spark.createDataFrame([(0, 0, -5.0), (0, 1, 5.0), (0, 2, 0.0)], "i bigint, j bigint, v double")
    assert dense(mx.matrix_relu(df)) == [[0, 5, 0]]
    assert dense(mx.matrix_sigmoid(df))[0][2] == 0.5
    assert dense(mx.matrix_tanh(df))[0][2] == 0.0
    g = dense(mx.matrix_gelu(df))[0]
    assert g[2] == 0.0 and abs(g[1] - 5.0) < 1e-5


def test_random_and_xavier(spark):
    r = mx.matrix_random(spark, 10, 10, 1, "r").collect()
    x = mx.matrix_xavier(spark, 10, 10, 1, "x").collect()
    assert sum(1 for c in r if c["v"] != 0) >= 90 and all(-1 <= c["v"] < 1 for c in r)
    lim = math.sqrt(6 / 20)
    assert sum(1 for c in x if c["v"] != 0) >= 90 and all(abs(c["v"]) <= lim for c in x)
    again = mx.matrix_random(spark, 10, 10, 1, "r").repartition(7).collect()
    assert sorted(tuple(c) for c in r) == sorted(tuple(c) for c in again)


def test_dropout(spark):
    m = mat(spark, [[1.0] * 50] * 20)
    assert dense(mx.dropout(m, 0.1, False)) == dense(m)
    vals = [c["v"] for c in mx.dropout(m, 0.5, True, seed=3).collect()]
    assert set(vals) <= {0.0, 2.0} and 300 < vals.count(0.0) < 700


def test_from_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0]), (2, [4.0, 5.0, 6.0])], "k bigint, vec array<double>")
    assert dense(mx.matrix_from_rows(df, "k", "vec")) == [[1, 2], [3, 0], [4, 5]]


def test_multiply_shuffle_path(spark):
    a, b = mat(spark, [[1, 2, 3], [4, 5, 6]]), mat(spark, [[7, 8], [9, 10], [11, 12]])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = mx.matrix_multiply(a, b)
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert dense(out) == [[58, 64], [139, 154]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_set_twice_keeps_one_cell(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "i int, j int, v double")
    u = spark.createDataFrame([(0, 0, 9.0, 1), (0, 0, 5.0, 2), (7, 7, 1.0, 1)], "i int, j int, v double, n int")
    got = sorted(tuple(r) for r in mx.matrix_set(m, u, "n").collect())
    assert got == [(0, 0, 5.0), (0, 1, 2.0)]
