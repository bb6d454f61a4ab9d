"""Decontamination against a brute-force search."""

import hashlib
import random
import re

import pytest

from wordmill.llm.decontam import contamination, decontaminate


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        x = words(t)
        m = window if len(x) >= window else len(x)
        for i in range(len(x) - m + 1 if m else 0):
            for j in range(len(w) - m + 1):
                if w[j : j + m] == x[i : i + m]:
                    hit |= set(range(j, j + m))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def rows(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return {
        r.doc_id: (r.hit_words, sum(s.end - s.start for s in r.hit_spans), list(r.hit_items))
        for r in contamination(d, i, **kw).collect()
    }


@pytest.mark.parametrize("shard_words", [25, 2_000_000])
def test_equals_brute_force(spark, shard_words):
    rnd = random.Random(4)
    pool = ["a", "b", "Ré", "d9", "E"]
    make = lambda n: " ".join(rnd.choice(pool) + rnd.choice(["", ",", " -"]) for _ in range(n))
    items = [(i, make(rnd.choice([0, 2, 5, 6, 9, 10, 11, 14]))) for i in range(30)] + [(77, None), (5, "A b a")]
    docs = [(i, make(rnd.randint(0, 60))) for i in range(60)] + [(90, None), (91, ""), (92, items[3][1])]
    docs += [(93, "x " * 3000 + (items[-3][1] or "") + " y" * 9), (92, items[3][1])]
    got = rows(spark, docs, items, window=6, shard_words=shard_words)
    for k, t in docs:
        assert got[k] == brute(t, items, 6), (k, t)


def test_empty_tables(spark):
    assert rows(spark, [(1, "a b")], []) == {1: (2, 0, [])}
    assert rows(spark, [], [(1, "a b")]) == {}


def test_removal_keeps_clean_text_and_other_columns(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame(
        [(1, "Clean,  TEXT\n stays.", "x"), (2, "Before " + item + " after that it goes on. " + "z " * 30, None),
         (3, item, "y"), (None, None, None)],
        "doc_id bigint, text string, hit_words string",
    )
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate(docs, items).collect()}
    assert got[1].text == "Clean,  TEXT\n stays." and got[1].hit_words == "x"
    assert got[2].text.split()[:3] == ["Before", "after", "that"] and "w3" not in got[2].text
    assert 3 not in got and got[None].text is None


def test_registered_query(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in e.queries()["op2_benchmark_decontamination"](spark, sf).collect()}
    assert any(r.contaminated for r in got.values())
    grams = {}
    for item, t in items:
        x = words(t)
        m = min(10, len(x))
        for i in range(len(x) - m + 1):
            grams.setdefault(tuple(x[i : i + m]), set()).add(str(item))
    for d in docs:
        w = words(d.text)
        hit, found = set(), set()
        for m in {len(g) for g in grams}:
            for j in range(len(w) - m + 1):
                if (g := tuple(w[j : j + m])) in grams:
                    hit |= set(range(j, j + m))
                    found |= grams[g]
        r = got[d.doc_id]
        want = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(found), want)
