"""Benchmark items without an id are found and removed, but not named."""

import pytest

from wordmill.llm.decontam import contamination, decontaminate


@pytest.mark.parametrize("shard_words", [5, 2_000_000])
def test_items_without_an_id(spark, shard_words):
    long, short = " ".join(f"w{i}" for i in range(12)), "only three words"
    named = " ".join(f"v{i}" for i in range(10))
    filler = "z " * 40
    items = spark.createDataFrame([(None, long), (None, short), (7, short), (8, named)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, f"{filler}{long} end"), (2, f"{filler}{short}"), (3, f"{filler}{named} {long}"), (4, filler)],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: r for r in contamination(docs, items, shard_words=shard_words).collect()}
    hit = {i: sum(s.end - s.start for s in r.hit_spans) for i, r in got.items()}
    assert hit == {1: 12, 2: 3, 3: 22, 4: 0}
    assert {i: list(r.hit_items) for i, r in got.items()} == {1: [], 2: ["7"], 3: ["8"], 4: []}
    kept = {r.doc_id: r.text.split() for r in decontaminate(docs, items, shard_words=shard_words).collect()}
    assert "w3" not in kept[1] and kept[1][-1] == "end" and "three" not in kept[2] and "v1" not in kept[3] + kept[1]
