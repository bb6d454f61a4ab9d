"""Line dedup of passages on fewer lines than a run."""

import random
import re

from pyspark.sql import functions as F

from wordmill.llm import lines

DOCS = "doc_id bigint, text string"


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(10_000)}" for _ in range(n))


def slow_kept(rows, run=3, words=50):
    """Kept texts by windows of ``run`` lines, or of fewer with ``words`` words."""
    seen, out = set(), []
    for _, text in rows:
        ls = text.split("\n")
        at = [i for i, x in enumerate(ls) if x.strip()]
        it = [ls[i].strip() for i in at]
        gone = set()
        for k in range(1, run + 1):
            for j in range(len(it) - k + 1):
                g = tuple(it[j : j + k])
                if k == run or len(" ".join(g).split()) >= words:
                    gone |= set(range(j, j + k)) if g in seen else set()
                    seen.add(g)
        drop = set()
        for j in sorted(gone):
            drop |= set(range(at[j - 1] if j - 1 in gone else at[j], at[j] + 1))
        out.append("\n".join(x for i, x in enumerate(ls) if i not in drop) if drop else text)
    return out


def test_passages_on_one_and_two_lines_go(spark):
    one, a, b = prose(1, 150), prose(2, 30), prose(3, 28)
    rows = [
        (1, one),
        (2, one),  # a copy of a one-line document
        (3, f"own start\n  {one} \nown end"),
        (4, f"{a}\n\n{b}\nmore of four"),
        (5, f"{a}\n{b}\nmore of five"),  # two lines, 58 words
        (6, f"{a}\nmore of six"),  # 30 words of it
        (7, prose(4, 49)),
        (8, prose(4, 49)),
        (9, f"{prose(5, 50)}\n{prose(5, 50)}"),  # twice in one document
    ]
    df = spark.createDataFrame(rows, DOCS)
    got = {r["__row"].doc_id: r for r in lines.dedup_lines(df).collect()}
    assert {i: got[i].n_removed for i, _ in rows} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 2, 6: 0, 7: 0, 8: 0, 9: 1}
    assert [got[i].kept for i, _ in rows] == slow_kept(rows)
    assert got[5].n_matches == 1 and got[5].kept == "more of five"
    assert 2 not in {r.doc_id for r in lines.without_repeats(df).collect()}
    assert all(r.n_removed == 0 for r in lines.dedup_lines(df, words=None).collect())


def test_mixed_lengths_equal_brute_force(spark):
    rnd = random.Random(7)
    pool = [prose(10 + i, n) for i, n in enumerate((60, 55, 30, 25, 20, 3, 2, 1))] + [""]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 5)))) for i in range(80)]
    got = {r["__row"].doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].kept for i, _ in rows] == slow_kept(rows)
    old = lines.dedup_lines(spark.createDataFrame(rows, DOCS).withColumn("x", F.lit(1)), words=None)
    assert {r["__row"].doc_id: r.kept for r in old.collect()} == dict(zip((i for i, _ in rows), slow_kept(rows, words=10**9), strict=True))
    assert re.search(r"\w", rows[0][1])
