"""Secrets of letters, allow-list words by part, and texts with many matches."""

import random
import time

from wordmill.llm import secrets

DOCS = "doc_id bigint, text string"


def found(spark, texts, **kw):
    rows = secrets.scan(spark.createDataFrame(list(enumerate(texts)), DOCS), **kw).collect()
    return {r.doc_id: [(x.s, x.e) for x in r.spans if x.k == 3] for r in rows}


def test_recall_of_random_letters(spark):
    rnd = random.Random(4)
    low = "abcdefghijklmnopqrstuvwxyz"
    for alphabet, least in ((low + low.upper(), {20: 0.85, 24: 0.95, 32: 0.98, 40: 0.98}), (low, {32: 0.75, 40: 0.9})):
        for size, share in least.items():
            texts = ["see " + "".join(rnd.choice(alphabet) for _ in range(size)) + " there" for _ in range(300)]
            got = found(spark, texts)
            assert sum(v == [(4, 4 + size)] for v in got.values()) >= share * 300, (alphabet, size)


def test_words_and_names_are_no_secrets(spark):
    texts = ["keitstlichschenverpflichtungen", "Einungtzheitgeungverlich", "the-quick-brown-fox-jumps-over", "INTERNATIONALISATION"]
    assert found(spark, texts) == {i: [] for i in range(len(texts))}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    letters = [m.m for r in secrets.scan(table).collect() for m in r.spans if m.k == 3 and m.m.isalpha()]
    assert letters == []


def test_an_allow_word_clears_its_own_part(spark):
    key = "q7Zp0XvK2mLw9RtB4sYd"
    texts = [f"sample/{key}", f"{key}/example", f"sample{key}", f"example/{'a' * 30}", key]
    got = found(spark, texts)
    assert [bool(got[i]) for i in range(5)] == [True, True, False, False, True]
    assert got[0] == [(0, 27)]  # the whole candidate is the span


def test_many_matches_in_one_text_take_linear_time(spark):
    key = "q7Zp0XvK2mLw9RtB4sYd"
    n = 100_000
    text = f"token=abcdefgh1 {key} " * (n // 2)
    took = time.time()
    spans = secrets.scan(spark.createDataFrame([(1, text)], DOCS)).first().spans
    took = time.time() - took
    assert len(spans) == n and took < 90
    step = len(f"token=abcdefgh1 {key} ")
    assert [(x.s, x.k, x.e) for x in spans[:2]] == [(0, 0, 15), (16, 3, 36)]
    assert (spans[-1].s, spans[-1].e) == ((n // 2 - 1) * step + 16, (n // 2 - 1) * step + 36)


def test_running_sums_equal_plain_ones(spark):
    from pyspark.sql import functions as F

    rows = [([i % 7 for i in range(size)],) for size in (0, 1, 255, 256, 257, 1000)]
    df = spark.createDataFrame(rows, "a array<int>")
    sums = secrets._running(F.col("a"), lambda x: x, lambda a, x: a + x, F.lit(0))
    for r in df.select("a", sums.alias("s")).collect():
        assert r.s == [sum(r.a[:i]) for i in range(len(r.a))]
