"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items go into one suffix automaton (its alphabet is the
items' vocabulary). A document streams through it word by word: the state and
the matched length tell the longest item substring that ends here, so a length
of ``window`` or more means the last ``window`` words occur in an item. Items
shorter than a window count when they occur whole: such an item marks the state
of its full text, and a mark is seen through the suffix links.

Test sets are small beside the corpus, but their size is not assumed: items go
into shards of at most ``shard_words`` words, one automaton each, and the
documents pass through the shards in a chain of narrow maps, each merging its
hits into the row. One shard is in memory per Python worker. Nothing is shuffled.

Before the automaton runs, numpy drops the stretches of a document that cannot
hold a match: words outside the items' vocabulary, and runs of known words that
are shorter than the shortest window. That skips no match.

Defined cases: a null or empty text has no words; an item without words never
matches; equal items are all reported; an item with a null id counts and is
removed like any other, but no list of item ids names it; repeated rows each get their result; an
empty document or item table works; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_text, read_table, register

WINDOW = 10
SHARD_WORDS = 2_000_000

# Lower-cases A-Z and turns every other ASCII character but digits into a space;
# bytes from 0x80 are parts of non-ASCII characters, which all belong to words.
_TO_WORDS = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class Automaton:
    """Generalised suffix automaton over word sequences.

    After ``add`` of all items, ``close`` computes for every state the short
    items that end there (through suffix links), and for every state whose
    substrings include one of ``window`` words the items that hold it."""

    def __init__(self, window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.own: list[set[str]] = [set()]  # items with a prefix that ends in the state
        self.short: list[set[str | None]] = [set()]  # short items whose whole text ends in the state
        self.min_window = window

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        self.own.append(set())
        self.short.append(set())
        return len(self.len) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of the substrings of ``q`` that end an occurrence after p."""
        if self.len[q] == self.len[p] + 1:
            return q
        copy = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, item: str | None, words: list[bytes]) -> None:
        last = 0
        for word in words:
            w = self.vocab.setdefault(word, len(self.vocab))
            known = self.next[last].get(w)
            if known is not None:
                last = self._split(last, w, known)
            else:
                new = self._state(self.len[last] + 1, {}, 0)
                p = last
                while p >= 0 and w not in self.next[p]:
                    self.next[p][w] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, w, self.next[p][w])
                last = new
            if item is not None:
                self.own[last].add(item)
        if 0 < len(words) < self.window:
            self.short[last].add(item)
            self.min_window = min(self.min_window, len(words))

    def close(self) -> Automaton:
        order = sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True)
        holds = self.own
        self.holds: dict[int, tuple[str, ...]] = {}
        for v in order:  # longest first: occurrences move up to the shorter suffixes
            u = self.link[v]
            if self.len[u] >= self.window:
                holds[u] |= holds[v]
            elif self.len[v] >= self.window:
                self.holds[v] = tuple(sorted(holds[v]))
        # The state whose substrings include the last ``window`` words.
        self.at_window = list(range(len(self.len)))
        self.ends: list[tuple[tuple[int, str | None], ...]] = [()] * len(self.len)
        for v in reversed(order):
            u = self.link[v]
            if self.len[u] >= self.window:
                self.at_window[v] = self.at_window[u]
            self.ends[v] = self.ends[u] + tuple((self.len[v], x) for x in sorted(self.short[v], key=lambda x: x or ""))
        del self.own, self.short
        return self

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans [start, end) inside occurrences of windows, and
        the items whose windows occur."""
        n = len(words)
        if n < self.min_window or not self.vocab:
            return [], set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int32, count=n)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).view(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a < self.min_window:
                continue
            state = length = 0
            for i, w in enumerate(ids[a:b].tolist(), a + 1):
                nxt = self.next[state]
                while w not in nxt and state:
                    state = self.link[state]
                    length = self.len[state]
                    nxt = self.next[state]
                state = nxt.get(w, 0)
                length = length + 1 if state else 0
                reach = 0
                if length >= self.window:
                    reach = self.window
                    at = self.at_window[state]
                    if at not in seen:
                        seen.add(at)
                        items.update(self.holds[at])
                for size, item in self.ends[state]:
                    if size <= length:
                        if item is not None:
                            items.add(item)
                        reach = max(reach, size)
                if reach:
                    if spans and spans[-1][1] >= i - reach:
                        spans[-1] = (min(spans[-1][0], i - reach), i)
                        while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                            (s, _), (t, e) = spans[-2:]
                            spans[-2:] = [(min(s, t), e)]
                    else:
                        spans.append((i - reach, i))
        return spans, items


def shards(items: DataFrame, window: int, shard_words: int) -> Iterator[Automaton]:
    """Automata over at most ``shard_words`` words each (one item at least);
    items stream to the driver partition by partition."""
    rows = items.select(F.col("item_id").cast("string").alias("i"), "text")
    one, size = Automaton(window), 0
    for row in rows.toLocalIterator(prefetchPartitions=False):
        words = words_of((row.text or "").encode())
        if size and size + len(words) > shard_words:
            yield one.close()
            one, size = Automaton(window), 0
        if words:
            one.add(row.i, words)
            size += len(words)
    yield one.close()


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(a + b):
        if out and out[-1][1] >= s:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """docs(text, ...) plus hit_words (long, words of the text), hit_spans
    (word numbers [start, end), merged) and hit_items (sorted item ids)."""
    sc = docs.sparkSession.sparkContext
    out = docs
    added = ("hit_words", "hit_spans", "hit_items")
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = "hit_words bigint, hit_spans array<struct<start:int,end:int>>, hit_items array<string>"
    for k, automaton in enumerate(shards(items, window, shard_words)):
        shard = sc.broadcast(automaton)

        def add(texts, batch=None, shard=shard):
            found = []
            for text in texts:
                words = words_of(text)
                found.append((len(words), *shard.value.hits(words)))
            earlier = batch and [batch.column(c).to_pylist() for c in added[1:]]
            spans, names = [], []
            for i, (_, s, x) in enumerate(found):
                if earlier:
                    s = _merge(s, [(y["start"], y["end"]) for y in earlier[0][i]])
                    x = x | set(earlier[1][i])
                spans.append([{"start": a, "end": b} for a, b in s])
                names.append(sorted(x))
            return {
                "hit_words": pa.array([n for n, _, _ in found], pa.int64()),
                "hit_spans": pa.array(spans, spans_type),
                "hit_items": pa.array(names, pa.list_(pa.string())),
            }

        out = map_text(out, add, schema, drop=added if k else (), with_batch=bool(k))
    return out


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_share: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Remove contaminated spans from the texts. A document that loses over
    ``max_share`` of its words goes whole. Columns of docs are kept; texts
    without a hit stay as they are, byte for byte."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")
    marked = contamination(docs.select("text", row), items, window, shard_words)

    hit = F.aggregate("hit_spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    marked = marked.where(hit <= F.col("hit_words") * F.lit(max_share))
    cut = map_text(
        marked,
        lambda texts, batch: {
            "__clean": pa.array(
                [
                    _without(t, [(s["start"], s["end"]) for s in spans]) if spans else t
                    for t, spans in zip(texts, batch.column("hit_spans").to_pylist(), strict=True)
                ],
                pa.binary(),
            ).cast(pa.string())
        },
        "__clean string",
        with_batch=True,
    )
    return cut.select(*[F.col("__clean").alias(c) if c == "text" else F.col(f"__row.`{c}`") for c in names])


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the words of ``spans`` and what stands between them."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_TO_WORDS))]
    out, last = [], 0
    for s, e in spans:
        out.append(text[last : at[s][0]])
        last = at[e - 1][1]
    return b"".join(out) + text[last:]


@register("op2_benchmark_decontamination")
def q_decontamination(spark, sf_dir):
    found = contamination(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("hit_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )

