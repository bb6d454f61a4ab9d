"""SimHash near-duplicates through shards of BK-trees.

Every document gets a 64-bit fingerprint from all its shingles; fingerprints link
at ``radius`` or fewer differing bits, and the components of the links are the
groups of copies. Only distinct fingerprints take part, so a group of thousands
of exact copies is one node.

Of six parts of the 64 bits, three differing bits leave three parts alone, so two
fingerprints at distance 3 or less agree in some three of the six parts: each
distinct fingerprint goes to 20 buckets (choice of three parts, their 32 bits).
Random fingerprints rarely share one, so buckets hold near copies and stay small
as the corpus grows; those of one member go. The members of a bucket form shard
trees of at most ``shard`` fingerprints; a fingerprint of one
shard also queries the earlier shards of its bucket, in blocks. In a shard tree
a node's children are keyed by their Hamming distance to it, and a search follows
the edges within the radius. No task returns pairs: it unites what it finds and
returns at most one row per member and one per query and component.

A shard tree is bounded by ``shard`` fingerprints and lives in the one task that
needs it, so nothing is broadcast. The links then go through rounds of large
stars and small stars, each written to the shared checkpoint folder.

Defined cases: a null or empty text has fingerprint zero; fewer words than a
shingle are one shingle; a null doc_id takes part, but is never the smallest id
of a component that has another; repeated rows are copies of each other; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .common import documents, map_text, register, row_key

SHINGLE = 3
RADIUS = 3
SPARE = 3  # parts of a fingerprint that links agree in, beside the radius parts that may differ
SHARD = 8192
LEAF = 48


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over XXH64 (seed 42) of the word shingles."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    cuts = map(slice, starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    n = len(words) - k + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 16384):  # 64 numbers per shingle: a piece at a time
        part = h[at : at + 16384].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs(text, ...) plus ``fp``, the fingerprint as a signed bigint."""

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return {"fp": pa.array(fps.view(np.int64))}

    return map_text(docs, run, "fp bigint")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def unite(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


class BKTree:
    """BK-tree over distinct fingerprints; nodes of few members are leaves
    that are compared at once."""

    def __init__(self, fps: np.ndarray, leaf: int = LEAF):
        self.fps = fps
        self.leaf = leaf
        self.root = self._build(np.arange(len(fps)))

    def _build(self, at: np.ndarray):
        # A tree is at most 65 wide per level; deep chains are flattened by the
        # leaves, and equal distances to 64 pivots in turn bound the depth.
        if len(at) <= self.leaf:
            return at
        pivot, rest = at[0], at[1:]
        d = np.bitwise_count(self.fps[rest] ^ self.fps[pivot])
        return pivot, {int(k): self._build(rest[d == k]) for k in np.unique(d)}

    def links(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, member) of positions within the radius, in blocks."""
        stack = [(self.root, np.arange(len(queries)))] if len(self.fps) else []
        while stack:
            node, q = stack.pop()
            if not len(q):
                continue
            if isinstance(node, np.ndarray):
                for s in range(0, len(q), 4096):
                    part = q[s : s + 4096]
                    near = np.bitwise_count(queries[part][:, None] ^ self.fps[node][None, :]) <= radius
                    i, j = np.nonzero(near)
                    yield part[i], node[j]
                continue
            pivot, children = node
            d = np.bitwise_count(queries[q] ^ self.fps[pivot]).astype(np.int16)
            hit = q[d <= radius]
            yield hit, np.full(len(hit), pivot)
            for k, child in children.items():
                stack.append((child, q[np.abs(d - k) <= radius]))


def _unite_small(fps: list[int], radius: int) -> Forest:
    """A plain BK-tree for a bucket of a few fingerprints: insert each one
    after its search."""
    forest = Forest(len(fps))
    children: list[dict[int, int]] = [{}]
    for i in range(1, len(fps)):
        x = fps[i]
        stack = [0]
        while stack:
            v = stack.pop()
            d = (x ^ fps[v]).bit_count()
            if d <= radius:
                forest.unite(i, v)
            for k, c in children[v].items():
                if -radius <= d - k <= radius:
                    stack.append(c)
        v = 0
        while (c := children[v].get(d := (x ^ fps[v]).bit_count())) is not None:
            v = c
        children[v][d] = i
        children.append({})
    return forest


class _Shard:
    """One shard tree with its components; queries come in any number."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius = fps, radius
        self.tree = None
        if len(fps) <= 24:
            self.forest = _unite_small(fps.tolist(), radius)
        else:
            self.tree = BKTree(fps)
            self.forest = Forest(len(fps))
            label = np.arange(len(fps))
            for q, m in self.tree.links(fps, radius):
                # A dense group has many links but few pairs of components.
                a, b = label[q], label[m]
                joins = np.unique(np.minimum(a, b)[a != b] * len(fps) + np.maximum(a, b)[a != b])
                if len(joins):
                    for x in joins.tolist():
                        self.forest.unite(*divmod(x, len(fps)))
                    label = self._roots()

    def _roots(self) -> np.ndarray:
        up = np.array(self.forest.up)
        while (up[up] != up).any():
            up = up[up]
        return up

    def stars(self) -> list[tuple[int, int]]:
        roots = ((i, self.forest.find(i)) for i in range(len(self.fps)))
        return [(int(self.fps[i]), int(self.fps[r])) for i, r in roots if i != r]

    def ask(self, queries: np.ndarray) -> list[tuple[int, int]]:
        if self.tree is None:
            self.tree = BKTree(self.fps)
        root = self._roots()
        out: set[tuple[int, int]] = set()
        for q, m in self.tree.links(queries, self.radius):
            out.update(zip(q.tolist(), root[m].tolist(), strict=True))
        return [(int(queries[i]), int(self.fps[r])) for i, r in out]


def links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Distinct fp -> (u, v): links that connect what the radius connects."""
    bounds = [64 * k // (radius + SPARE) for k in range(radius + SPARE + 1)]

    def value(chosen: tuple[int, ...]) -> Column:
        """The chosen parts of fp, in place."""
        mask = sum(((1 << bounds[k + 1] - bounds[k]) - 1) << bounds[k] for k in chosen)
        return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))

    choices = combinations(range(radius + SPARE), SPARE)
    keys = [F.struct(F.lit(i).alias("b"), value(c).alias("v")) for i, c in enumerate(choices)]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.b", "k.v")
    sizes = rows.groupBy("b", "v").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, ["b", "v"])
    own = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / shard)).cast("int")
    # A member of shard j queries the shards before it.
    rows = (
        rows.withColumn("own", own)
        .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("own"))))
        .select("b", "v", "s", (F.col("s") != F.col("own")).cast("int").alias("role"), "fp")
    )
    ship_package(fps.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        members: list[np.ndarray] = []
        tree: _Shard | None = None

        def batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            uv = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], names=["u", "v"])

        def close() -> tuple[_Shard, list[tuple[int, int]]]:
            made = _Shard(np.concatenate(members), radius)
            return made, made.stars()

        for rows in batches:
            b, v, s, role, fp = (c.to_numpy(zero_copy_only=False) for c in rows.columns)
            fp = fp.view(np.uint64)
            out: list[tuple[int, int]] = []
            change = (np.diff(b) != 0) | (np.diff(v) != 0) | (np.diff(s) != 0) | (np.diff(role) != 0)
            edge = [0, *(np.flatnonzero(change) + 1).tolist(), len(fp)]
            for lo, hi in zip(edge, edge[1:], strict=False):
                if lo == hi:
                    continue
                here = (b[lo], v[lo], s[lo])
                if here != key:
                    if members and tree is None:
                        out += close()[1]
                    key, members, tree = here, [], None
                if role[lo] == 0:
                    members.append(fp[lo:hi])
                elif members:
                    if tree is None:
                        tree, stars = close()
                        out += stars
                    out += tree.ask(fp[lo:hi])
            if out:
                yield batch(out)
        if members and tree is None:
            yield batch(close()[1])

    return (
        rows.repartition("b", "v", "s")
        .sortWithinPartitions("b", "v", "s", "role", "fp")
        .mapInArrow(run, "u bigint, v bigint")
    )


def components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, root): star of each component with a link, by rounds of
    large stars and small stars until nothing changes."""
    edges = cut_lineage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        sign = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if sign.n == 0 or sign == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = sign
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
        )
        small = large.join(small_min, "u").select(F.explode(pairs).alias("e"))
        edges = cut_lineage(small.select("e.u", "e.v").where("u <> v").distinct())


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, keys: bool = False
) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fp, component_id per row; with ``keys``
    also the row key, and the least (doc_id, row) of the component."""
    key = row_key(docs)
    marked = cut_lineage(
        fingerprints(docs.select(F.col("doc_id").alias("__id"), "text", *key), shingle).select(
            F.col("__id").alias("doc_id"), "__wm_d", "__wm_t", "fp"
        )
    )
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("d"), F.min(F.struct("__wm_d", "__wm_t")).alias("first"))
    stars = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "d", "first"
    )
    least = rooted.groupBy("root").agg(F.min("d").alias("component_id"), F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id", "first")
    out = marked.join(named, "fp")
    return out if keys else out.select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row with the smallest doc_id of each group, with all its columns."""
    found = near_duplicates(docs, shingle, radius, keys=True)
    kept = found.where(F.struct("__wm_d", "__wm_t") == F.col("first")).select("__wm_d", "__wm_t").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(*row_key(docs), row).join(kept, ["__wm_d", "__wm_t"])
    # Rows equal in every column share a key; one of them stays.
    return rows.dropDuplicates(["__wm_d", "__wm_t"]).select("__row.*")


@register("op5_simhash_near_dedup")
def q_simhash(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
