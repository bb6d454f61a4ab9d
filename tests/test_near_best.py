"""The shortcuts over all V logits give what the logits themselves give."""

import hashlib

import numpy as np
import pytest
from wordmill.functions.random import hash_uniform_rows
from wordmill.operators import blocked


def test_sums_by_the_series_or_not_at_all():
    rng = np.random.default_rng(1)
    h = rng.normal(size=(700, 8))
    for size, given in ((0.0001, True), (0.003, True), (0.3, False), (30.0, False)):
        w = rng.uniform(-size, size, (5000, 8))
        got, want = blocked.exp_sums(h, w), np.exp(h @ w.T).sum(axis=1) if given else None
        assert (got is not None) == given
        if given:
            np.testing.assert_allclose(got, want, rtol=blocked.SERIES)
    assert blocked.exp_sums(h[:3], w) is None and blocked.exp_sums(h, w[:0]) is None
    h[5, 2] = np.nan
    assert blocked.exp_sums(h, rng.uniform(-0.003, 0.003, (5000, 8))) is None


@pytest.mark.parametrize("size", (0.004, 3.0))
def test_near_best_hold_the_best(size):
    rng = np.random.default_rng(2)
    h, w = rng.normal(size=(130, 16)), rng.uniform(-size, size, (9001, 16))
    w[::9] *= 0.97  # and some equal rows, in several tiles
    w[4000:4020] = w[17]
    row, col = np.nonzero(rng.random((130, 9001)) < 0.01)
    full = h @ w.T
    full[row, col] = -np.inf
    for k in (1, 40):
        r, c, x = blocked._best_of(h, w, w.astype(np.float32), (row, col), k)
        np.testing.assert_allclose(x, full[r, c], rtol=1e-9, atol=1e-12)
        for i in range(130):
            edge = np.sort(full[i])[-k]
            mine = set(c[r == i])
            assert set(np.flatnonzero(full[i] > edge + 1e-9)) <= mine and len(mine) >= k
            assert mine <= set(np.flatnonzero(full[i] >= edge - 1e-9))


def test_more_equal_rows_than_there_is_room_for():
    h, w = np.ones((3, 4)), np.full((5000, 4), 0.5)
    assert blocked._best_of(h, w, w.astype(np.float32), (np.zeros(0, int), np.zeros(0, int)), 5) is None
    w[:] = 0
    w[77] = 1
    assert blocked._best_of(h, w, w.astype(np.float32), (np.zeros(0, int), np.zeros(0, int)), 1)[1].tolist() == [77] * 3


def test_scores_over_a_wide_vocabulary_equal_all_logits(spark):
    """One model with small weights and one with large ones, more states than the
    series needs."""
    from conftest import seqs_df
    from pyspark.sql import functions as F
    from wordmill.operators.params import ModelShape, init_params
    from wordmill.operators.scoring import predict_next

    shape = ModelShape(vocab_size=9000, embed_size=8, hidden_size=16, num_layers=1)
    seqs = seqs_df(spark, [[2, 5 + i, 7, (9 * i) % 9000, 3, 9999, -4] for i in range(60)])
    for times in (0.05, 40.0):
        params = init_params(spark, shape, seed=3).withColumn("vec", F.when(F.col("param") == "output_layer", F.transform("vec", lambda x: x * times)).otherwise(F.col("vec"))).cache()
        full = {}
        for r in predict_next(seqs, params, shape).collect():
            full.setdefault(r.seq_id, {})[r.token_id] = r.p
        got = {}
        for r in predict_next(seqs, params, shape, top=5).collect():
            got.setdefault(r.seq_id, {})[r.token_id] = r.p
        for s, p in full.items():
            seen = {2, 5 + s, 7, (9 * s) % 9000, 3}
            want = seen | set(sorted((t for t in p if t not in seen), key=lambda t: (-p[t], t))[:5])
            assert set(got[s]) == want and all(got[s][t] == pytest.approx(p[t], rel=1e-9) for t in want)


@pytest.mark.parametrize("cols", (1, 16, 101))
def test_cells_hashed_side_by_side_are_the_same_numbers(cols):
    rows = np.array([0, 9, 10, 12345, 10**12])
    want = [[int(hashlib.md5(f"7:embedding:{r}:{c}".encode()).hexdigest()[:8], 16) / 2**32 for c in range(cols)] for r in rows]
    assert (hash_uniform_rows(7, "embedding", rows, cols) == np.array(want)).all()
    assert hash_uniform_rows(7, "embedding", rows[:0], cols).shape == (0, cols)
