import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from wordmill.llm.negatives import bit_planes, hard_negatives, integer_vectors, scores, subset_sums


def slow(rows, is_anchor):
    """rows: (id, label, integers); a list of result rows."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    high = lambda i: 2**63 - 1 if i is None else i
    out = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or not is_anchor(i):
            continue
        dot = lambda w: sum(x * y for x, y in zip(v, w, strict=False))  # noqa: B023, E731
        others = sorted((-dot(w), high(j), j, other) for k, (j, other, w) in enumerate(rows) if k != at)
        for p, _, positive, other in [o for o in others if o[3] == label][:5]:
            fit = [o for o in others if o[3] != label and -30 * p <= -100 * o[0] <= -90 * p][:10]
            out += [(i, positive, rank, o[2], -p, -o[0]) for rank, o in enumerate(fit, 1)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, label int, v array<bigint>").repartition(3)


def run(spark, rows, **sizes):
    got = hard_negatives(frame(spark, rows), F.col("id") % 3 == 0, **sizes)
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["negative_score"] == "bigint"
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_lookups_give_inner_products():
    rng = np.random.default_rng(5)
    for low, high, dtype in ((-3, 4, np.int32), (-(2**20), 2**20, np.int64), (0, 2, np.int32), (-1, 0, np.int32)):
        a, r = rng.integers(low, high, (7, 24)), rng.integers(low, high, (50, 24))
        planes = bit_planes(r)
        assert (scores(subset_sums(a.astype(dtype)), planes) == r @ a.T).all()
    assert subset_sums(np.arange(8, dtype=np.int64)[None])[0, 0b10000110, 0] == 1 + 2 + 7


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 3), [rng.randint(-2, 9) for _ in range(11)]) for i in range(90)]
    rows += rows[:6] * 3 + [(12, 1, [5] * 11), (12, 0, [5] * 11)]  # copies, and one id on several rows
    rows += [(None, 1, [4] * 11), (200, None, [9] * 11), (201, 1, None), (0, 2, [1, 9]), (3, 2, []), (6, 1, [1] * 20)]
    want = slow(rows, lambda i: i % 3 == 0)
    assert len(want) > 300 and any(r[3] is None or r[1] is None for r in want)
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=7, block_anchors=4) == want


def test_ties_take_smaller_ids_and_hot_labels_lose_nothing(spark):
    rows = [(i, 0, [10]) for i in range(40)] + [(100 + i, 1, [5]) for i in range(40)]
    got = run(spark, rows, block_rows=5)
    mine = [r for r in got if r[0] == 3]
    assert sorted({r[1] for r in mine}) == [0, 1, 2, 4, 5]
    assert [r[3] for r in sorted(mine, key=lambda r: (r[1], r[2]))[:10]] == list(range(100, 110))
    assert got == slow(rows, lambda i: i % 3 == 0)


def test_large_components_stay_exact(spark):
    big = 2**31
    rows = [(0, 0, [big, 1]), (1, 0, [big, 2]), (2, 1, [big // 2, 3]), (4, 1, [big // 2, 4]), (5, 1, [-big, 0])]
    assert run(spark, rows) == slow(rows, lambda i: i % 3 == 0) != []


def test_empty_tables_and_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, 1, [1]), (1, 2, [1])]) == []  # no other row of the label
    assert run(spark, [(1, 1, [1]), (2, 2, [1])]) == []  # no anchor
    assert run(spark, [(0, 1, [1]), (1, 1, [1]), (2, 2, [-1])]) == []  # no fitting score


def test_the_contract_reads_labels_and_vectors(spark):
    rows = [
        (7, [0.5, -0.001], 9),
        (8, [0.5, math.nan], 1),
        (9, [math.inf, 1.0], 1),
        (10, [None, 1.0], 1),
        (11, None, 1),
        (14, [0.999], None),
        (None, [1.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, id string")
    got = {r.id: (r.label, r.v) for r in integer_vectors(df).collect()}
    assert got[7] == (0, [128, -1]) and got[14] == (None, [255]) and got[None] == (3, [256])
    assert all(got[i][1] is None for i in (8, 9, 10, 11))


def test_a_score_beyond_64_bits_is_an_error(spark):
    rows = [(0, 0, [2**62] * 4), (1, 0, [2**62] * 4), (2, 1, [2**61] * 4)]
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        run(spark, rows)
