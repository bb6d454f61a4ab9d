"""Suffix arrays and byte-string dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from wordmill.llm import substrings as sub
from wordmill.llm.gsaca import suffix_array


def test_suffix_array():
    rnd = random.Random(3)
    for size, letters in [(1, 1), (5, 1), (40, 1), (60, 2), (200, 3), (500, 30)] * 8:
        t = [rnd.randint(1, letters) for _ in range(size)] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])
    t = [2, 1, 2, 1, 2, 1, 3, 2, 1, 2, 1, 0]
    assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute(texts, n):
    """Per text: (bytes, removed, spans, kept hash)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + n] for b in data for i in range(len(b) - n + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, x in zip(b, gone, strict=True) if not x)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, n, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    out = sub.dedup_substrings(df, n, **kw).collect()
    return sorted(
        (
            -1 if r["__row"].doc_id is None else r["__row"].doc_id,
            r.n_bytes,
            sum(x.e - x.s for x in r.removed),
            len(r.removed),
            hashlib.sha256(bytes(r.kept)).hexdigest(),
        )
        for r in out
    )


def make_texts(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7))) for _ in range(60)]
    prose = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    shared = [prose(rnd.randint(30, 90)) for _ in range(3)]
    texts = [prose(rnd.randint(0, 150)) for _ in range(15)]
    texts += [prose(rnd.randint(0, 30)) + rnd.choice(shared) + prose(rnd.randint(0, 30)) for _ in range(14)]
    for t in texts[:6]:  # near copies with edits
        b = list(t)
        for _ in range(2):
            if b:
                b[rnd.randrange(len(b))] = "Z"
        texts.append("".join(b))
    texts += [texts[3], "ab" * 300, "x" * 700, "x" * 450, shared[0] + shared[0], None, ""]
    return texts


@pytest.mark.parametrize(("seed", "group", "n"), [(0, 20_000, 200), (1, 2, 200), (2, 20_000, 150)])
def test_equals_brute_force(spark, seed, group, n):
    texts = make_texts(seed)
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    want = [(i, *x) for i, x in enumerate(brute(texts, n))]
    assert run(spark, rows, n, group=group) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i * 7919 % 1000}" for i in range(200))
    rows = [(1, long, None), (1, long, None), (None, None, None), (5, "short", "y")]
    texts = [r[1] for r in rows]
    want = sorted((-1 if r[0] is None else r[0], *x) for r, x in zip(rows, brute(texts, 200), strict=True))
    assert run(spark, rows, 200) == want
    assert run(spark, [], 200) == []


def test_hot_classes(spark, monkeypatch):
    """A hot class beside ordinary ones, equal rows among its copies: one join
    marks the rows of both and makes one row for each."""
    monkeypatch.setattr(sub, "HOT_SHARE", 4)
    word = lambda k: " ".join(f"w{i * k % 9973}" for i in range(90))
    texts = [word(7919)] * 40 + [f"{i} {word(6007)} {i}" for i in range(3)] + [word(4409)]
    rows = [(i // 2 if i < 20 else i, t, "x") for i, t in enumerate(texts)]
    want = sorted((r[0], *x) for r, x in zip(rows, brute(texts, 200), strict=True))
    assert run(spark, rows, 200) == want
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "__wm_d bigint, __wm_t bigint, text string")
    spans = sub.repeated_spans(docs, 200)
    copies = sum(len(r.spans) for r in spans.where("d < 40").collect())
    assert copies == 40 * len(spans.where("d = 0").first().spans)
    plan = spans._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LeftAnti" not in plan


def test_segments(monkeypatch):
    """Long texts are hashed in segments; every window is in one context."""
    rnd = random.Random(9)
    text = bytes(rnd.randrange(97, 123) for _ in range(5000))
    monkeypatch.setattr(sub, "SEGMENT", 700)
    starts = []
    for _, p, lo, hi in sub.anchors(text):
        for x, a, b in zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True):
            starts += [x - o for o in range(a, b + 1)]
    assert sorted(starts) == list(range(len(text) - 199))


def test_registered_query(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: x for d, x in zip(docs, brute([d.text for d in docs], 200), strict=True)}
    got = e.queries()["op3_suffix_array_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert any(r.n_removed for r in got)
