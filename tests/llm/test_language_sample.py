"""The language sample is of distinct texts and bounded per language."""

import random

import numpy as np

from wordmill.llm import language


def test_copies_do_not_change_the_sample(spark, monkeypatch):
    rnd = random.Random(3)
    word = lambda j: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz"[j : j + 14]) for _ in range(6))
    rows = [(" ".join(word(j) for _ in range(12)), f"l{j}") for j in range(12) for _ in range(60)]
    sizes = []
    cluster = language._cluster
    monkeypatch.setattr(language, "_cluster", lambda x, k: sizes.append(len(x)) or cluster(x, k))
    once = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample=10)
    assert len(sizes) == 12 and max(sizes) <= 10 and sum(sizes) > 60
    copied = rows + [r for r in rows if r[1] in ("l0", "l5")] * 20
    often = language.fit(spark.createDataFrame(copied, "text string, lang string"), sample=10)
    assert sizes[12:] == sizes[:12]
    assert np.array_equal(once.idf, often.idf) and np.array_equal(once.centroids, often.centroids)


def test_toxicity_sample_has_a_hard_bound(spark):
    """Repeated rows of documents and labels neither reach the driver nor weigh more."""
    from wordmill.llm import toxicity

    base = [(i, f"the word{i} of thing{i} you idiot scum" if i % 2 else f"the word{i} of thing{i} is here") for i in range(60)]
    docs = spark.createDataFrame(base * 5 + [(1, "zz another text"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 7 + [(None, 1)], "doc_id long, toxic int")
    seen = []
    train, toxicity.train = toxicity.train, lambda bags: seen.extend(bags)
    try:
        toxicity.fit(docs, labels, sample=10)
        assert sorted(y for _, y in seen) == [0] * 10 + [1] * 10
        seen.clear()
        toxicity.fit(docs, labels, sample=1000)
        assert len(seen) == 60
    finally:
        toxicity.train = train


def test_language_equals_the_definition(spark):
    """Nearest centroid by cosine over TF-IDF n-gram vectors, worked out plainly."""
    import numpy as np

    from wordmill.llm import language

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(table.where("doc_id % 4 <> 0"), sample=40)
    rows = language.identify(table, model).collect()
    assert len(set(model.of.tolist())) == 4 and len(model.of) > 4
    for r in rows[:80]:
        text = (r.text or "").encode()
        if not language.has_letter(text):
            assert r.lang_pred == "und"
            continue
        letters = "".join(c if c.isalpha() or not c.isascii() else " " for c in r.text.lower())
        clean = " ".join(w for w in letters.split(" ") if w)
        raw = f" {clean} ".encode()
        weight = {}
        for n, bits, first in ((2, language.BITS2, 0), (3, language.BITS3, 1 << language.BITS2)):
            for i in range(len(raw) - n + 1):
                h = sum(c * m for c, m in zip(raw[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False)) % 2**32
                h = (h ^ (h >> 15)) * 0x27D4EB2F % 2**32
                at = first + (h >> (32 - bits))
                weight[at] = weight.get(at, 0) + 1
        v = {at: np.log1p(c) * float(model.idf[at]) for at, c in weight.items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        cosines = [sum(x * float(c[at]) for at, x in v.items()) / norm for c in model.centroids]
        best = int(np.argmax(cosines))
        assert r.lang_pred == model.languages[model.of[best]] and abs(r.lang_score - cosines[best]) < 1e-4
        assert r.lang_near == (cosines[best] >= model.reach[best] - language.MARGIN)
