import random
import re
from collections import Counter

from wordmill.llm.collocations import _HashCounts, _buffers, _by_text, _chunks, _unpack, collocations, frequent_phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def slow_counts(rows, max_words):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", " ".join(w[i : i + k])] += 1
    return f, n


def slow_collocations(rows, min_count, max_words=3):
    f, n = slow_counts(rows, max_words)
    cand = {}
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        if len(w) > 1 and a >= min_count:
            cuts = []
            for k in range(1, len(w)):
                left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            cand[lang, phrase] = (a, left, right, score)
    out = []
    for (lang, phrase), (a, left, right, score) in cand.items():
        longer = [b[0] for (x, p), b in cand.items() if x == lang and len(p) > len(phrase) and f" {phrase} " in f" {p} "]
        if not any(100 * b >= 50 * a for b in longer):
            out.append((lang, -score, -a, phrase.encode(), left, right))
    out.sort()
    seen, ranked = Counter(), set()
    for lang, score, a, phrase, left, right in out:
        seen[lang] += 1
        ranked.add((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def texts(seed, docs=60):
    rng = random.Random(seed)
    words = ["ab", "Ab", "cd", "é", "x-y", "zz", "q", "\x1cw"]
    marks = [" ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    return [
        (rng.choice(["en", "en", "de", None]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40))))
        for _ in range(docs)
    ]


def df(spark, rows, parts=3):
    return spark.createDataFrame([(x, t, 7) for x, t in rows], "lang string, text string, phrase int").repartition(parts)


def test_equals_brute_force_whatever_the_sample(spark):
    rows = texts(1)
    want = slow_collocations(rows, 4)
    assert len(want) > 30
    for one_in, sample_count, bits in ((1, 1, 20), (2, 2, 20), (3, 1, 8), (10**9, 1, 20)):
        got = collocations(df(spark, rows), top=None, min_count=4, one_in=one_in, sample_count=sample_count, bits=bits)
        assert {tuple(r) for r in got.collect()} == want, (one_in, bits)


def test_border_failures_are_counted_until_closed(spark):
    rows = texts(2)
    f, n = slow_counts(rows, 4)
    want = {(lang, p, c) for (lang, p), c in f.items() if c >= 4}
    # No document is drawn: words fail first, then pairs, then triples.
    found, passes = frequent_phrases(df(spark, rows), 4, 4, one_in=10**9, sample_count=1)
    got = [(r.lang, r.phrase, r.c) for r in found.where("k > 0").collect()]
    assert passes == 4 and len(got) == len(set(got)) and set(got) == want
    words = found.where("k = 0").groupBy("lang").sum("c").collect()
    assert {r[0]: r[1] for r in words} == dict(n)
    # Everything proposed: the second pass names what the first found.
    found, passes = frequent_phrases(df(spark, rows), 4, 4, one_in=1, sample_count=1)
    assert passes == 2 and {(r.lang, r.phrase, r.c) for r in found.where("k > 0").collect()} == want


def test_scores_ties_and_the_drop_rule(spark):
    rows = [("en", "New York City. " * 12 + "new york. " * 4 + "a b a b a b a b a b a b a b a b a b a b a")]
    got = {r.phrase: r for r in collocations(df(spark, rows)).collect()}
    # 100 * 12 >= 50 * 16 drops the pair; the triple's lesser cut is the first: 12 * 12 / (16 * 12).
    assert "new york" not in got and "york city" not in got
    assert (got["new york city"].a, got["new york city"].l, got["new york city"].r) == (12, 16, 12)
    assert got["new york city"].score == 750000
    # Overlaps count: a b a stands ten times, b a b nine times (not a candidate).
    assert got["a b a"].a == 10 and "b a b" not in got and "a b" not in got
    assert [got["a b a"].l, got["a b a"].r] == [11, 10]
    assert got["a b a"].n == 12 * 3 + 8 + 21


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), ("en", " . ,"), ("und", "u v " * 10), (None, "u v"), ("en", "a\vb " * 12)]
    want = slow_collocations(rows, 10)
    got = {tuple(r) for r in collocations(df(spark, rows)).collect()}
    assert got == want and {(r[0], r[2], r[3]) for r in got} == {("und", "u v", 11), ("en", "b a", 11)}
    assert collocations(df(spark, rows).limit(0)).count() == 0


def test_long_texts_are_cut_at_piece_ends():
    raw = b"a b.c d.e f g h i j k l.m"
    assert list(_chunks(raw, 6)) == [b"a b", b"c d", b"e f g h i j k l", b"m"]
    assert b".".join(_chunks(raw, 5)) == raw and list(_chunks(raw, 100)) == [raw]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y", "x"], "text": ["A b. C", None, "d;e " * 5]})
    held = list(_buffers(iter([batch]), 1, 8))
    assert {k for k, _ in held} == {"x"} and max(len(v) for _, v in held) < 16
    assert b".".join(v for _, v in held).replace(b". ", b".") == b"a b.c.d.e d.e d.e d.e d.e "


def test_phrases_of_one_hash_are_told_apart():
    import numpy as np
    import pyarrow as pa

    ids = np.array([0, 1, 2, 0, 1, 2, 1, 0])
    words = pa.array([b"a", b"b", b"c"], pa.large_binary())
    same = np.zeros(7, np.uint64)
    got = Counter()
    for text, c in _by_text(same, np.arange(7), 2, ids, words):
        got.update(dict(zip(text.to_pylist(), c.tolist(), strict=True)))
    assert got == {b"a b": 2, b"b c": 2, b"c a": 1, b"c b": 1, b"b a": 1}


def test_counted_hashes_survive_packing():
    import numpy as np

    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2)
    h = h[rng.integers(0, 5000, 30000)]
    held = _HashCounts()
    rows = [held.add(2, h[:20000]), held.add(3, h[20000:])]
    assert all(list(r) == [] for r in rows)
    out = held.flush()
    want = Counter(((int(x) >> 20 << 4 | k) << 16) for k, part in ((2, h[:20000]), (3, h[20000:])) for x in part)
    got = {}
    for b, z in zip(out.column("b").to_pylist(), out.column("z").to_pylist(), strict=True):
        for x, c in zip(*(y.tolist() for y in _unpack(z)), strict=True):
            assert x >> 52 == b
            got[x] = c
    assert got == dict(want) and held.flush().num_rows == 0
