import random
import re

import pytest
from wordmill.llm.licenses import BASE, NOTICES, LicenceAutomaton, Template, chains, license_spans, scan, words_of
from wordmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow_base(text):
    w = plain_words(text)
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    return sorted((i, label) for label, p in phrases.items() for i in range(len(w)) if w[i : i + len(p)] == p)


def spans_of(text, templates, **kw):
    auto = LicenceAutomaton(tuple(templates), kw.pop("min_match", 4))
    return scan(auto, words_of(text.encode()), kw.get("max_gap", 12), kw.get("min_cover", 0.6))


def test_matching_statistics_equal_the_definition():
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(4)]
        auto = LicenceAutomaton(tuple(Template("t", t) for t in texts))
        file = [rng.choice("abcd") for _ in range(40)]
        ids = [auto.vocab.get(w.encode(), -1) for w in file]
        held = {tuple(w[i:j]) for t in texts for w in [t.split()] for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        for i, (length, state) in enumerate(auto.statistics(ids)):
            want = max((n for n in range(1, i + 2) if tuple(file[i + 1 - n : i + 1]) in held), default=0)
            assert length == want
            if not length:
                continue
            # Every place of the match in every template, and no other.
            part = file[i + 1 - length : i + 1]
            places = [(t, j) for t, x in enumerate(texts) for w in [x.split()] for j in range(length, len(w) + 1) if w[j - length : j] == part]
            assert sorted(auto.places(state)) == places


def test_base_places_equal_brute_force(spark):
    rng = random.Random(7)
    words = "CC By general Public license all rights reserved x é".split()
    texts = ["".join(rng.choice(words) + rng.choice([" ", "-", "\n", " 1 "]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, lic string")
    got = license_spans(docs)
    assert got.columns[:3] == docs.columns
    seen = 0
    for r in got.collect():
        base = [(b.start, b.label) for b in r.lic_base]
        assert base == slow_base(r.text) and r.lic_words == len(plain_words(r.text))
        assert {b[1] for b in base} <= {s.label for s in r.lic_spans}
        seen += len(base)
    assert seen > 50


def test_query_equals_brute_force_on_the_table(spark):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_license_scan"](spark, SF).collect()
    assert len(rows) == len(table)
    for r in rows:
        base = slow_base(table[r.doc_id])
        assert (r.n_words, r.n_base) == (len(plain_words(table[r.doc_id])), len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], max(b[0] for b in base)) if base else (None, None))
        assert r.base_labels == ",".join(sorted({b[1] for b in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_an_edited_licence_is_one_span_over_its_gaps():
    text = next(t.text for t in NOTICES if t.label == "bsd")
    w = text.split()
    edited = w[:12] + ["acme"] * 3 + w[12:30] + w[33:]  # words put in, words left out
    file = ["hello"] * 20 + edited + ["bye"] * 20
    base, spans = spans_of(" ".join(file), BASE + NOTICES)
    assert base == [] and len(spans) == 1
    start, end, label, cover = spans[0]
    assert label == "bsd" and 0.9 < cover < 1.0
    assert start == 20 and end == len(plain_words(" ".join(file))) - 20
    # A third of it, or its words in another order, is no such span.
    assert spans_of(" ".join(w[:15]), BASE + NOTICES)[1] == []
    shuffled = w[:]
    random.Random(1).shuffle(shuffled)
    assert spans_of(" ".join(shuffled), BASE + NOTICES)[1] == []


def test_parts_out_of_order_or_far_apart_are_not_chained():
    t = Template("t", "a b c d e f g h i j k l")
    assert spans_of("a b c d e f x g h i j k l", [t], min_cover=1.0)[1] == [(0, 13, "t", 1.0)]
    assert spans_of("g h i j k l a b c d e f", [t], min_cover=0.6)[1] == []
    far = "a b c d e f " + "x " * 13 + "g h i j k l"
    assert spans_of(far, [t], min_cover=0.6)[1] == []
    assert spans_of(far, [t], min_cover=0.6, max_gap=13)[1] == [(0, 25, "t", 1.0)]
    # Twice the whole text: two spans.
    assert [s[:2] for s in spans_of(t.text + " z " + t.text, [t])[1]] == [(0, 12), (13, 25)]


def slow_best(matches, gap):
    """Most words that a chain of matches covers, by trying every order."""
    best = 0

    def grow(last, covered):
        nonlocal best
        best = max(best, covered)
        for e, t, n in matches:
            cut = max(last[0] - (e - n), last[1] - (t - n), 0) if last else 0
            if cut >= n or (last and (e <= last[0] or t <= last[1])):
                continue
            if last and (e - n + cut - last[0] > gap or t - n + cut - last[1] > gap):
                continue
            grow((e, t), covered + n - cut)

    grow(None, 0)
    return best


def test_the_widest_chain_equals_brute_force():
    rng = random.Random(11)
    for _ in range(300):
        m = []
        for _ in range(rng.randint(1, 6)):
            n = rng.randint(1, 5)
            m.append((rng.randint(n, 20), rng.randint(n, 20), n))
        gap = rng.randint(0, 5)
        out = chains(m, gap)
        assert max(c for c, _, _ in out) == slow_best(sorted(set(m)), gap)


def test_short_notices_and_labels():
    for text, label in (
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ):
        assert label in {s[2] for s in spans_of("foo bar " + text + " baz", BASE + NOTICES)[1]}
    assert spans_of("the license of the software and the rights of all", BASE + NOTICES) == ([], [])


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (2, "..."), (3, "cc"), (4, "cc by " * 20000), (4, "cc by " * 20000), (None, "CC-BY")]
    got = license_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = sorted((r.doc_id or 0, r.lic_words, len(r.lic_base), len(r.lic_spans)) for r in got)
    assert size == [(0, 2, 1, 1), (1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 0, 0), *[(4, 40000, 20000, 20000)] * 2]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_spans(empty).count() == 0
    none = license_spans(spark.createDataFrame(rows, "doc_id long, text string"), templates=(Template("x", " . "),))
    assert all(not r.lic_spans for r in none.collect())
    with pytest.raises(ValueError, match="bounded"):
        license_spans(empty, templates=(Template("x", "a " * 1_000_001),))
