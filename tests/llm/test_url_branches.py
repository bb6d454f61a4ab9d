"""The url tree counts shapes, takes unlabelled branches along and grows to
the deepest level."""

from wordmill.llm import urls


def judged(spark, pages, **kw):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, url string")
    return {r.page_id: r for r in urls.judge_urls(df, **kw).collect()}


def tree(bad=12, good=12):
    """A host whose /bad/ urls are blocked and /good/ ones allowed."""
    pages = [f"http://h.com/bad/p/name-{i}/x" for i in range(bad)] + [f"http://h.com/good/q/item/{i}" for i in range(good)]
    return pages, (("block", "h.com/bad"), ("allow", "h.com/good"))


def test_repeated_rows_change_no_verdict(spark):
    pages, rules = tree()
    pages += ["http://h.com/free/p/name-77/x", "http://h.com/else/z"]
    pages += [f"http://h.com/shop/item{x}" for x in "abcdefghijklmnop"]
    once = judged(spark, pages, rules=rules)
    often = judged(spark, pages * 5, rules=rules)
    assert {r.template for r in once.values() if "/shop" in r.path} == {"/shop/*/"}
    for i, r in often.items():
        same = once[i % len(pages)]
        assert (r.template, r.purity, r.verdict) == (same.template, same.purity, same.verdict)


def test_a_like_branch_follows_many_labels(spark):
    pages = [f"http://example.com/de/{i}" for i in range(20)] + ["http://example.com/en/77", "http://example.com/shop/cart"]
    pages += [f"http://x.org/fr/{i}" for i in range(20)] + ["http://x.org/en/2"]
    got = {(r.host, r.path): r for r in judged(spark, pages).values()}
    like, other = got["example.com", "/en/77"], got["example.com", "/shop/cart"]
    assert (like.rule, like.template, like.verdict) == (None, "/~+/*/", "block")
    assert (other.rule, other.template, other.verdict) == (None, "/shop/cart/", "allow")
    assert got["x.org", "/en/2"].template == "/~-/*/" and got["x.org", "/en/2"].verdict == "allow"


def test_one_vote_never_blocks_another_branch(spark):
    for votes in (1, 3, 8):
        pages = [f"http://example.com/de/{i}" for i in range(votes)] + [f"http://example.com/en/{i}" for i in range(5)]
        got = judged(spark, pages)
        assert {r.verdict for r in got.values() if r.path.startswith("/en")} == {"allow"}
        assert {r.verdict for r in got.values() if r.path.startswith("/de")} == {"block"}  # the rule's


def test_labels_of_another_host_flip_nothing(spark):
    pages, rules = tree()
    pages += ["http://h.com/free/p/name-77/x", "http://h.com/else/z"]
    more = [f"http://other.org/a/{c}/{i}" for c in "abcdefgh" for i in range(30)]
    for kind in ("block", "allow"):
        alone = judged(spark, pages, rules=rules)
        both = judged(spark, pages + more, rules=(*rules, (kind, "other.org/")))
        assert all(both[i][:7] == alone[i][:7] for i in alone)


def test_the_lower_bound_decides(spark):
    """Mixed labels in one merged branch stay below the threshold."""
    rows = [(9, 9), (8, 8), (20, 17), (20, 19), (0, 0), (1000, 770), (1000, 780)]
    df = spark.createDataFrame(rows, "n long, b long")
    got = [r[0] for r in df.select(urls.lower_bound(df.b, df.n)).collect()]
    assert [x is not None and x >= urls.PURITY for x in got] == [True, False, False, True, False, False, True]
    assert got[4] is None


def test_tree_grows_to_the_deepest_level(spark):
    deep = "a/b/c/d/e/f/g/h"
    got = judged(spark, [f"http://h.com/{deep}/{x}" for x in ("left", "right")], rules=())
    assert {r.template for r in got.values()} == {f"/{deep}/left/", f"/{deep}/right/"}


def test_a_long_path_costs_no_round(spark, monkeypatch):
    """Two urls of 2,000 segments that part halfway: one branching, so two rounds."""
    rounds = []
    whole = urls._branch_names
    monkeypatch.setattr(urls, "_branch_names", lambda at: rounds.append(1) or whole(at))
    same = "/".join(f"s{i}x" for i in range(1000))
    tails = ["/".join(f"{t}{i}x" for i in range(1000)) for t in "ab"]
    got = judged(spark, [f"http://h.com/{same}/{t}" for t in tails] + ["http://h.com/x", "http://i.com/" + same], rules=())
    assert len(rounds) == 3
    assert {r.template for r in got.values()} == {f"/{same}/{t}/" for t in tails} | {"/x/", f"/{same}/"}


def test_common_prefix_of_a_chain_with_ends(spark):
    pages = ["http://h.com/a", "http://h.com/a/b", "http://h.com/a/b/c", "http://h.com/", "http://h.com"]
    got = judged(spark, pages, rules=())
    assert [got[i].template for i in range(5)] == ["/a/", "/a/b/", "/a/b/c/", "/", "/"]
