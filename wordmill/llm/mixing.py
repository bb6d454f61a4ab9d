"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are summed by membership
pattern (the sorted set of their sources), which leaves a small network: tokens
flow from the patterns to the sources of each pattern and on to the sources'
quotas. A pattern offers its size once per allowed repetition, and repetition r
costs 2r - 1 per token, so that the total is convex (r squared) and fresh text
goes first. Successive shortest paths route as much as fits at the least cost.

The flow gives each pattern a number of tokens to take. Its documents stand in
a seeded order (MD5 of seed and doc_id); with every document at [start, start +
size) of its pattern, repetition r takes the part of it under the amount that is
left after r - 1 whole rounds. The last document of a round is taken in part, so
a pattern gives its amount to the token.

The driver holds one number per pattern and source. The running sums over
documents come from range partitions by (pattern, order), so a hot source spreads
over many tasks, and the texts themselves are only counted.

Quotas: sources in code-point order, nulls last, weigh 5, 2, 1, repeating, and
share ``share`` times all tokens; none exceeds ``repeats`` times its source, and
what is over goes to the others by weight, until it fits.

Defined cases: a null text has size 0 and nothing taken; a null source is a
source of its own; rows equal in every column share one result (their common
amount, split evenly and rounded down); an empty table gives no rows; reruns
agree since nothing depends on partitions.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators._util import global_prefix_sum
from ..session import cut_lineage
from .common import WORD, documents, register, row_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix"

Pattern = tuple[str | None, ...]


def quotas(
    sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> dict[str | None, float]:
    """Target tokens of each source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > repeats * sizes[s]]
        if not over:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            out[s] = float(repeats * sizes[s])
            left -= out[s]
            open_.remove(s)
    return {s: round(out[s], 6) for s in order}


def route(sizes: dict[Pattern, int], targets: dict[str | None, float], repeats: int = REPEATS) -> dict[Pattern, float]:
    """Tokens to take of each pattern: a least-cost largest flow from patterns
    (``size`` per repetition r at cost 2r - 1) to the quotas of their sources."""
    patterns, sources = list(sizes), list(targets)
    number = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    n = 2 + len(patterns) + len(sources)
    graph: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    cost: list[int] = []

    def arc(a: int, b: int, capacity: float, price: int) -> int:
        for x, y, r, c in ((a, b, capacity, price), (b, a, 0.0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    first: list[list[int]] = []
    for i, p in enumerate(patterns):
        first.append([arc(0, 2 + i, float(sizes[p]), 2 * r - 1) for r in range(1, repeats + 1)])
        for s in p:
            arc(2 + i, number[s], math.inf, 0)
    for s in sources:
        arc(number[s], 1, targets[s], 0)

    height = [0.0] * n
    while True:
        far = [math.inf] * n
        via = [-1] * n
        far[0] = 0.0
        heap = [(0.0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in graph[a]:
                if room[e] > 1e-6 and (x := d + cost[e] + height[a] - height[to[e]]) < far[to[e]] - 1e-9:
                    far[to[e]], via[to[e]] = x, e
                    heapq.heappush(heap, (x, to[e]))
        if via[1] < 0:
            break
        height = [h + d if d < math.inf else h for h, d in zip(height, far, strict=True)]
        path, at = [], 1
        while at:
            path.append(via[at])
            at = to[via[at] ^ 1]
        step = min(room[e] for e in path)
        for e in path:
            room[e] -= step
            room[e ^ 1] += step
    return {p: sum(room[e ^ 1] for e in arcs) for p, arcs in zip(patterns, first, strict=True)}


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def mix(
    docs: DataFrame,
    sources: Column,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> tuple[DataFrame, dict[str | None, int], dict[str | None, float]]:
    """docs(doc_id, text, ...) with ``sources`` an array column of the sources
    of each row. Returns a table of distinct rows: __wm_d, __wm_t, doc_id,
    sources, copies (rows that are equal), size and taken (each per row), and
    the sizes and targets of the sources."""
    spark = docs.sparkSession
    sized = docs.select(
        *row_key(docs), "doc_id", F.array_sort(F.array_distinct(sources)).alias("sources"), word_count(F.col("text")).alias("size")
    )
    units = cut_lineage(
        sized.groupBy("__wm_d", "__wm_t")
        .agg(F.first("doc_id").alias("doc_id"), F.first("sources").alias("sources"), F.first("size").alias("size"), F.count("*").alias("copies"))
        .withColumn("all", F.col("size") * F.col("copies"))
    )
    sums = {tuple(r.sources): r.n for r in units.groupBy("sources").agg(F.sum("all").alias("n")).collect()}
    sizes: dict[str | None, int] = {}
    for p, size in sums.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + size
    targets = quotas(sizes, weights, share, repeats)
    take = route(sums, targets, repeats)

    order = sorted(sums, key=lambda p: [(s is None, s or "") for s in p])
    rows, start = [], 0
    for i, p in enumerate(order):
        rows.append((list(p), i, start, sums[p], math.floor(take[p] + 0.5)))
        start += sums[p]
    table = spark.createDataFrame(
        rows, "sources array<string>, pattern int, pattern_start bigint, pattern_size bigint, pattern_take bigint"
    )
    tagged = units.join(table, "sources").withColumn(
        "order", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    )
    placed = global_prefix_sum(tagged, ["pattern", "order", "__wm_d", "__wm_t"], "all", "lo")
    lo = F.col("lo") - F.col("pattern_start")
    taken: Column = F.lit(0).cast("bigint")
    for r in range(repeats):
        left = F.col("pattern_take") - r * F.col("pattern_size") - lo
        taken = taken + F.greatest(F.lit(0), F.least(F.col("all"), left))
    per_row = F.when(F.col("copies") > 1, F.floor(taken / F.col("copies"))).otherwise(taken).cast("bigint")
    out = placed.withColumn("taken", per_row).select(
        "__wm_d", "__wm_t", "doc_id", "sources", "copies", "size", "taken"
    )
    return out, sizes, targets


def _with_targets(spark, mixed: DataFrame, sizes: dict, targets: dict) -> DataFrame:
    """Adds source_size and target of the single source of each row."""
    table = spark.createDataFrame(
        [([s], sizes[s], targets[s]) for s in sizes], "sources array<string>, source_size bigint, target double"
    )
    return mixed.join(table, "sources")


def select_mix(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, source, ...) -> the documents that the mix takes, with
    their columns and size, source_size, target and taken as ``mix_*``."""
    mixed, sizes, targets = mix(docs, F.array("source"))
    chosen = _with_targets(docs.sparkSession, mixed.where("taken > 0"), sizes, targets)
    names = ["size", "source_size", "target", "taken"]
    chosen = chosen.select("__wm_d", "__wm_t", F.struct(*names).alias("__mix"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    out = docs.select(*row_key(docs), row).join(chosen, ["__wm_d", "__wm_t"])
    taken = set(docs.columns)
    return out.select(
        "__row.*", *[F.col(f"__mix.{c}").alias(c2) for c in names if (c2 := f"mix_{c}") not in taken]
    )


_WEIGHT = f"[{', '.join(map(str, WEIGHTS))}]"
_ORACLE = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
        md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
      s AS (SELECT source, sum(size)::BIGINT AS n, {REPEATS} * sum(size)::DOUBLE AS cap FROM d GROUP BY source),
      w AS (SELECT *, {_WEIGHT}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w FROM s),
      k AS (SELECT *, ({SHARE} * sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM w),
      u AS (SELECT max(unit) FILTER (unit * w <= cap) AS unit FROM k),
      t AS (SELECT k.source, k.n, round(least(cap, coalesce(u.unit, 1e300) * w), 6) AS target FROM k, u),
      p AS (SELECT d.*, t.n AS n, t.target, floor(t.target + 0.5)::BIGINT AS cut,
          coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
      SELECT doc_id, size, n AS source_size, target,
        ({" + ".join(f"greatest(0, least(size, cut - {r} * n - lo))" for r in range(REPEATS))})::BIGINT AS taken FROM p"""


@register("op6_source_mix", _ORACLE)
def q_mix(spark, sf_dir):
    mixed, sizes, targets = mix(documents(spark, sf_dir, "doc_id", "text", "source"), F.array("source"))
    rows = _with_targets(spark, mixed, sizes, targets).withColumn(
        "__n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    )
    return rows.select("doc_id", "size", "source_size", "target", "taken")
