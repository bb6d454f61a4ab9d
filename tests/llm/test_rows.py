"""Odd rows and brute-force checks of the operators whose queries have SQL, and
of the classifiers and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.llm import language, lines, mixing, quality, secrets, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None)[:4] for r in rows], DOCS)


# ------------------------------------------------------------------ quality
def slow_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    ls = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls)), len(covered))


def slow_bucket(v):
    shift = max(0, v.bit_length() - 6)
    return shift * 32 + (v >> shift)


def slow_kept(rows, min_group=100):
    """doc number -> kept, with sketches and fences in plain Python."""
    counts = [slow_counts(r[1]) for r in rows]
    lines_ = [len([x for x in (r[1] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]) for r in rows]
    failed = [c[0] < 20 or 100 * c[4] > 30 * c[0] for c in counts]
    values = [
        c[0] and (c[2] * 1000 // c[0], c[1] * 1000 // c[0], c[3] * 1000 // max(1, n), c[4] * 1000 // c[0])
        for c, n in zip(counts, lines_, strict=True)
    ]

    def quartiles(group, k):
        b = sorted(slow_bucket(values[i][k]) for i in group)
        out = []
        for q in (1, 3):
            x = b[(len(b) * q + 3) // 4 - 1]
            shift = max(0, x // 32 - 1)
            out.append((x - shift * 32) << shift)
        return out

    good = [i for i in range(len(rows)) if not failed[i]]
    out = []
    for i, r in enumerate(rows):
        ok = not failed[i]
        for k, rule in enumerate(quality.RULES):
            if failed[i]:
                break
            for same in (lambda j: rows[j][2:4] == r[2:4], lambda j: rows[j][2] == r[2], lambda j: True):
                group = [j for j in good if same(j)]
                if len(group) >= min_group:
                    break
            q25, q75 = quartiles(group, k)
            width = max((q75 - q25) * quality.SPREAD, rule.slack)
            ok &= values[i][k] <= q75 + width and (not rule.low or values[i][k] >= q25 - width)
        out.append(ok)
    return out


def test_quality_equals_plain_python(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in table.collect()]
    for group in (100, 5):
        got = {r.doc_id: r for r in quality.quality_rules(table, group).collect()}
        for r, kept in zip(rows, slow_kept(rows, group), strict=True):
            g = got[r[0]]
            assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == slow_counts(r[1])
            assert g.kept == kept, r[0]


def test_quality_odd_rows(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    df = docs(spark, [(1, None), (2, ""), (3, clean), (3, clean), (None, "a b c d e f g h " * 9, None, "s")])
    df = df.withColumn("kept", F.lit("mine"))
    got = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in quality.quality_rules(df).collect())
    assert got == [(0, 72, True, False), (1, 0, True, False), (2, 0, True, False), (3, 40, False, True), (3, 40, False, True)]
    good = quality.keep_good(df)
    assert good.columns == df.columns and [r.kept for r in good.collect()] == ["mine", "mine"]
    assert quality.keep_good(df.limit(0)).count() == 0


# ------------------------------------------------------------------ secrets
def test_secret_spans(spark):
    key = "q7Zp0XvK2mLw9RtB4sYd"
    text = f"é API_KEY: 'abcd1234' token=short AKIAABCDEFGHIJKL {'0af' * 12} see {key} or {'a' * 30}"
    df = docs(spark, [(1, text), (2, None), (3, ""), (4, "x" * 200_000 + " " + key), (1, text)]).withColumn("spans", F.lit(1))
    got = secrets.scan(df).collect()
    by = {r.doc_id: [(secrets.KINDS[x.k], text[x.s : x.e] if r.doc_id == 1 else x.s) for x in r.spans] for r in got}
    assert by[1] == [("assign", "API_KEY: 'abcd1234"), ("access", "AKIAABCDEFGHIJKL"), ("hex", "0af" * 12), ("entropy", key)]
    assert by[2] == by[3] == [] and by[4] == [("entropy", 200_001)]
    assert len(got) == 5 and secrets.scan(df.limit(0)).count() == 0
    assert all(x.k < 3 for r in secrets.scan(df, allow=(key,)).collect() for x in r.spans)


# ------------------------------------------------------------------ lines
def slow_lines(rows, run=3, words=50):
    """Kept texts; rows in order of place. Windows are ``run`` lines, or fewer
    that hold ``words`` words."""
    first, out = {}, []
    for _, text in rows:
        ls = (text or "").split("\n")
        at = [i for i, x in enumerate(ls) if re.search(r"[^\x20\x09-\x0D]", x)]
        it = [ls[i].strip(" \t\n\r\x0b\x0c") for i in at]
        size = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in it]
        gone = set()
        for k in range(1, run + 1):
            for j in range(len(it) - k + 1):
                if k < run and sum(size[j : j + k]) < words:
                    continue
                g = tuple(it[j : j + k])
                if g in first:
                    gone |= set(range(j, j + k))
                first.setdefault(g, 1)
        spans, j = [], 0
        for j in sorted(gone):
            if spans and spans[-1][1] == j - 1:
                spans[-1][1] = j
            else:
                spans.append([j, j])
        drop = {i for a, b in spans for i in range(at[a], at[b] + 1)}
        out.append("\n".join(x for i, x in enumerate(ls) if i not in drop) if drop else text)
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(5)
    texts = ["\n".join(rnd.choice(["a", "b ", "c", "", " d"]) for _ in range(rnd.randint(0, 14))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "u\nv\nw\n\nu\nv\nw", "a\nb\nc\na\nb\nc" * 40])]
    df = docs(spark, rows).withColumn("runs", F.lit("x"))
    got = {r["__row"].doc_id: r.kept for r in lines.dedup_lines(df).collect()}
    assert [got[i] for i, _ in rows] == slow_lines(rows)
    assert lines.without_repeats(df).columns == df.columns
    assert lines.without_repeats(df.limit(0)).count() == 0


def test_equal_rows_are_one_document(spark):
    t = "one\ntwo\nthree\nfour"
    got = lines.without_repeats(docs(spark, [(1, t), (1, t), (None, t), (2, t + "\nfive")])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, t), (1, t), (2, "five")]


# ------------------------------------------------------------------ language
def test_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rest = [(-1, None), (-2, ""), (-3, "123 !?"), (-4, "é" * 300_000), (None, "the and of"), (None, "the and of")]
    model = language.fit(table.where("doc_id % 4 <> 0"), sample=60)
    odd = docs(spark, rest).withColumn("lang_pred0", F.lit("x"))
    got = language.identify(odd, model).collect()
    assert [r.lang_pred for r in got if (r.doc_id or 0) in (-1, -2, -3)] == ["und"] * 3
    assert all(0 <= r.lang_score <= 1 for r in got) and len(got) == 6
    held = language.identify(table.where("doc_id % 4 = 0").withColumnRenamed("lang", "truth"), model)
    assert held.agg(F.avg((F.col("truth") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    none = language.fit(table.limit(0))
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}
    assert language.identify(table.limit(0), model).count() == 0


# ------------------------------------------------------------------ mixing
def test_quotas_and_flow():
    sizes = {"a": 100, "b": 100, None: 10}
    q = mixing.quotas(sizes)
    assert q == {"a": 200.0, None: 20.0, "b": 95.0}
    assert sum(q.values()) == pytest.approx(1.5 * 210)
    # Overlap: the shared pattern serves the source that lacks own text.
    take = mixing.route({("a",): 100, ("a", "b"): 50, ("b",): 10}, {"a": 120.0, "b": 60.0})
    assert sum(take.values()) == pytest.approx(160 + 20) and take[("a",)] >= 100
    one = mixing.route({("a", "b"): 30}, {"a": 100.0, "b": 5.0})
    assert one == {("a", "b"): pytest.approx(60.0)}


def test_convex_costs_spread_repeats():
    """Fresh text goes before any second copy."""
    take = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 20.0, "b": 0.0})
    assert take == {("a",): pytest.approx(10.0), ("a", "b"): pytest.approx(10.0)}


def test_mix_rows(spark):
    rows = [(i, "w " * (i % 7), None, s) for i, s in enumerate("aabbbcc" * 6)] + [(90, None, None, None), (91, "x y", None, None)] * 2
    df = docs(spark, rows).withColumn("taken", F.lit("mine"))
    mixed, sizes, targets = mixing.mix(df, F.array("source"))
    got = mixed.collect()
    for s, n in sizes.items():
        own = [r for r in got if r.sources == [s]]
        assert sum(r.size * r.copies for r in own) == n
        assert all(0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken * r.copies for r in own) - targets[s]) <= 2
    chosen = mixing.select_mix(df)
    assert chosen.columns == [*df.columns, "mix_size", "mix_source_size", "mix_target", "mix_taken"]
    assert all(r.taken == "mine" and r.mix_taken > 0 for r in chosen.collect())
    assert mixing.select_mix(df.limit(0)).count() == 0


def test_overlapping_sources(spark):
    df = docs(spark, [(i, "w " * 10, None, "ab"[i % 2]) for i in range(20)])
    both = F.when(F.col("doc_id") < 10, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    mixed, sizes, targets = mixing.mix(df, both)
    assert sizes == {"a": 150, "b": 150} and targets == {"a": pytest.approx(300 * 1.5 * 5 / 7, abs=30), "b": targets["b"]}
    assert sum(r.taken for r in mixed.collect()) == round(min(400, sum(targets.values())))


# ------------------------------------------------------------------ toxicity
def slow_kernel(s, t, n, d=toxicity.DECAY):
    """Sum over pairs of index sets that spell the same n characters."""
    from itertools import combinations

    out = 0.0
    for i in combinations(range(len(s)), n):
        for j in combinations(range(len(t)), n):
            if all(s[a] == t[b] for a, b in zip(i, j, strict=True)):
                out += d ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return out


def test_kernel_equals_definition():
    words, marks = [b"idxiot", b"at", b"", b"statt"], [b"idiot", b"tat"]
    got = toxicity.kernel(words, marks)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            s, t = b"^" + w + b"$", b"^" + m + b"$"
            want = 0.0
            for n in toxicity.ORDERS:
                norm = (slow_kernel(s, s, n) * slow_kernel(t, t, n)) ** 0.5
                want += slow_kernel(s, t, n) / norm if norm else 0.0
            assert got[i, j] == pytest.approx(want / len(toxicity.ORDERS), abs=1e-5)


def test_folded_weights_equal_the_kernel_sum():
    words = [b"", b"a", b"ab", b"idiot", b"idxiot", b"aaaa", "caf\u00e9".encode(), b"x" * 24, b"abcdefghijklmnop"]
    marks = [b"idiot", b"aab", b"", "caf\u00e9s".encode(), b"abcdefghijklmnopqrstuvwx"]
    weights = np.array([0.7, -1.3, 0.2, 2.0, -0.4])
    want = toxicity.kernel(words, marks) @ weights
    assert toxicity.Folded(marks, weights)(words) == pytest.approx(want, abs=1e-5)
    assert toxicity.Folded([], np.zeros(0))(words).tolist() == [0.0] * len(words)


def test_toxicity_held_out_and_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    fold = lambda m: F.expr(f"crc32(cast(doc_id as string)) % 3 {m} 1")
    model = toxicity.fit(table, labels.where(fold("<>")))
    held = toxicity.score(table, model).join(labels.where(fold("=")), "doc_id").collect()
    pos, neg = ([r.toxicity for r in held if r.toxic == y] for y in (1, 0))
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc > 0.85
    filler = "the onth and reeaand of thtion was inger that onnd " * 3
    odd = docs(spark, [(1, None), (2, ""), (3, "y" * 100_000), (4, filler), (5, filler + " you idiot scum moron"), (5, filler)])
    got = {(r.doc_id, r.text): r.toxicity for r in toxicity.score(odd.withColumn("score", F.lit(2)), model).collect()}
    assert got[1, None] == got[2, ""] == 0.0 and got[5, filler + " you idiot scum moron"] > got[4, filler]
    assert all(0 <= x <= 1 for x in got.values())
    none = toxicity.fit(table, labels.limit(0))
    assert {r.toxicity for r in toxicity.score(odd, none).collect()} == {0.0}
    assert toxicity.score(table.limit(0), model).count() == 0


# ------------------------------------------------------------------ urls
def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.NET/en/x?y"), (4, "http://example.net?x"), (5, "x://b.org/fr/a/b/c/d/e/f/g/h"),
             (6, "http://notexample.com/de/1"), (7, "http://m.example.com/de/1"), (7, "http://m.example.com/de/1"), (8, "http://net/"), (None, "http://e.net/\n#z")]
    df = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("host", F.lit("mine"))
    got = sorted(((r.page_id or 0), r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect())
    assert got == [
        (0, "e.net", "/\n", "net/", "block"), (1, "", "", None, "allow"), (2, "", "", None, "allow"),
        (3, "a.example.net", "/en/x", "example.net/en/", "allow"), (4, "example.net", "", None, "allow"),
        (5, "b.org", "/fr/a/b/c/d/e/f/g/h", "org/fr/", "allow"), (6, "notexample.com", "/de/1", None, "allow"),
        (7, "m.example.com", "/de/1", "example.com/de/", "block"), (7, "m.example.com", "/de/1", "example.com/de/", "block"),
        (8, "net", "/", "net/", "block"),
    ]
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_branches_generalise_merge_and_reject(spark):
    """Variable segments merge; bad siblings pool; a template of blocked pages
    takes unlabelled ones with it."""
    rules = (("block", "h.com/bad"), ("block", "h.com/worse"), ("allow", "h.com/good"))
    pages = [f"http://h.com/{k}{sep}{i}" for k in ("bad", "worse", "good") for i in range(6) for sep in ("/p/name-x", "/")]
    pages += [f"http://h.com/free/item{'abcdefghijklmnop'[i]}" for i in range(16)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, url string")
    got = urls.judge_urls(df, rules).collect()
    tops = {r.path.split("/")[1]: r.template.split("/")[1] for r in got}
    assert tops == {"bad": "~+", "worse": "~+", "good": "good", "free": "free"}
    assert {r.template for r in got if r.path.startswith("/free")} == {"/free/*/"}
    assert all(r.verdict == ("block" if r.path[1] in "bw" else "allow") for r in got)


# ------------------------------------------------------------------ pipeline
def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from test_decontam import words as plain_words
    from test_simhash import slow_components, slow_fingerprint

    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in table.orderBy("doc_id").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    rows = [r for r, ok in zip(rows, slow_kept(rows), strict=True) if ok]
    kept = slow_lines([r[:2] for r in rows])
    rows = [(r[0], t, *r[2:]) for r, t in zip(rows, kept, strict=True) if t == r[1] or re.search(r"[^\x20\x09-\x0D]", t)]
    comp = slow_components([(r[0], slow_fingerprint(r[1])) for r in rows])
    rows = [r for r, c in zip(rows, comp, strict=True) if r[0] == c]
    grams = {tuple(w[i : i + 10]) for t in items for w in [plain_words(t)] for i in range(len(w) - 9)}
    out = []
    for r in rows:
        at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r[1])]
        w = plain_words(r[1])
        hit = {k for i in range(len(w) - 9) if tuple(w[i : i + 10]) in grams for k in range(i, i + 10)}
        if 2 * len(hit) > len(w):
            continue
        text, last = "", 0
        for k in sorted(hit):
            text += r[1][last : at[k][0]] if k - 1 not in hit else ""
            last = at[k][1]
        out.append((r[0], text + r[1][last:], *r[2:]))
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in out}
    total = Counter()
    for r in out:
        total[r[3]] += size[r[0]]
    targets = mixing.quotas(dict(total))
    want = set()
    for s, n in total.items():
        lo, cut = 0, int(targets[s] + 0.5)
        for r in sorted((x for x in out if x[3] == s), key=lambda x: hashlib.md5(f"mix:{x[0]}".encode()).hexdigest()):
            k = size[r[0]]
            taken = max(0, min(k, cut - lo)) + max(0, min(k, cut - n - lo))
            lo += k
            if taken:
                want.add((r[0], r[1], taken))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[: len(table.columns)] == table.columns
    assert {(r.doc_id, r.text, r.mix_taken) for r in got.collect()} == want and len(want) > 50


def test_stages_take_odd_tables(spark, tmp_path):
    import corpus_pipeline

    t = " ".join(f"tok{i * 37 % 101}" for i in range(60))
    full = docs(spark, [(1, t, "en", "s"), (1, t, "en", "s"), (None, None, None, None), (2, "", None, "s"), (None, t + " more", None, None)])
    full = full.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("kept", F.lit(1)).withColumn("size", F.lit(2))
    for table in (full, full.limit(0)):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, SF)
            if i < 4:
                assert out.columns == table.columns, name
            out.collect()


def test_crc_folds():
    assert zlib.crc32(b"12") % 4 in range(4)
