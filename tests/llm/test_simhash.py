"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash

from wordmill.llm import simhash as sh


def slow_fingerprint(text, k=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    """(id, fp) -> component by trying all pairs."""
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3 and comp[i] != comp[j]:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    least = {}
    for (k, _), c in zip(rows, comp, strict=True):
        if k is not None:
            least[c] = min(least.get(c, k), k)
    return [least.get(c) for c in comp]


def test_fingerprint():
    for t in [None, "", " \t", "One", "a B", "a b c", "É x\x1cy z " * 40, "w " * 70000, "Ab cd\x0bef\xa0g hi jk"]:
        assert sh.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_trees_find_all_links():
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = list({b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 5))) & (2**64 - 1) for b in base for _ in range(30)})
    arr = np.array(fps, np.uint64)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3}
    got = [(i, j) for q, m in sh.BKTree(arr, leaf=5).links(arr, 3) for i, j in zip(q.tolist(), m.tolist(), strict=True)]
    assert set(got) == want and len(got) == len(want)
    rows = [(i, f) for i, f in enumerate(fps)]
    for shard in (sh._Shard(arr, 3).forest, sh._unite_small(fps, 3)):
        roots = [shard.find(i) for i in range(len(fps))]
        assert len(set(zip(roots, slow_components(rows), strict=True))) == len(set(roots))


def test_components_with_split_buckets(spark):
    rnd = random.Random(2)
    fps = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            x ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
    fps |= {0, 1, 2**63}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(f - 2**64 if f >= 2**63 else f,) for _, f in rows]
    edges = sh.links(spark.createDataFrame(signed, "fp bigint"), shard=4)
    root = {r.node % 2**64: r.root % 2**64 for r in sh.components(edges).collect()}
    got = [root.get(f, f) for _, f in rows]
    want = slow_components(rows)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_odd_rows(spark):
    docs = [(3, None, "x"), (7, "", None), (5, "the same text again and again", "x"), (4, "The same text again and again", "y"),
            (4, "The same text again and again", "y"), (None, "the  same text again and again", "z"), (9, "quite another one, this", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, fp string")
    got = {(r.doc_id, r.component_id) for r in sh.near_duplicates(df).collect()}
    assert got == {(3, 3), (7, 3), (5, 4), (4, 4), (None, 4), (9, 9)}
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.fp) for r in kept.collect()) == [(3, "x"), (4, "y"), (9, "x")]
    assert sh.near_duplicates(df.limit(0)).count() == 0


def test_registered_query(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(d.doc_id, slow_fingerprint(d.text)) for d in docs]
    want = {k: (f"{f:016x}", c) for (k, f), c in zip(rows, slow_components(rows), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in e.queries()["op5_simhash_near_dedup"](spark, sf).collect()}
    assert got == want
