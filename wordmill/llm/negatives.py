"""Hard-negative mining with exact scores by the Four-Russians method.

Scores are integer inner products of anchors with all rows. The dimensions form
groups of eight. For a group, an anchor's 256 subset sums are tabled once; a
candidate's components are cut into bit planes (two's complement), so that the
eight bits of a plane in a group make one byte, which is an index into the table.
A score is the sum over planes of the looked-up sums, shifted by the plane's
place, the sign plane subtracted. It is exact: tables are of 32 bits where no
score can pass them, of 64 bits else, and of Python integers beyond.

Rows equal in id, label and vector are one candidate with a count. Candidates are
dealt by hash into blocks of about ``block_rows``, anchors into blocks of about
``block_anchors``; every pair of blocks meets once in one group of bounded size,
in two rounds: one scores rows of the anchor's label for its positives, the other
the rest for its negatives. So each anchor is scored against each row once. A
block gives at most ``positives`` or ``negatives`` rows per anchor (and
positive); the best of all blocks follow by rank, which Spark cuts map-side.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; vectors of unequal length count missing components as
zero; integers of components beyond 64 bits are clamped there, and a score beyond
64 bits raises an error; repeated rows
are candidates of their own, as are repeated anchors; an anchor's id may belong
to other rows too; a null id is 2^63 - 1 in the order of ties and null again in the result; ties go to the
smaller id; an anchor without other rows of its label, or a positive without a fitting row, has
no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import read_table, ship_package
from .common import register, written

POSITIVES = 5
NEGATIVES = 10
LEAST, MOST = 30, 90  # a negative's score as a percentage of the positive's
BLOCK_ROWS = 4096
BLOCK_ANCHORS = 4096
NO_ID = 2**63 - 1
_GROUP = 8
_AT_ONCE = 64  # anchors whose tables are held together
_ROWS_AT_ONCE = 1024


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as int64, short ones filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """int64 rows (n, 8 g) -> bytes (planes, g, n): bit ``b`` of the components of
    each group of eight, packed; the last plane is the sign's."""
    top = max(int(rows.max(initial=0)), -int(rows.min(initial=0)) - 1, 0)
    planes = top.bit_length() + 1
    n, d = rows.shape
    out = np.empty((planes, d // _GROUP, n), np.uint8)
    for b in range(planes):
        bits = ((rows >> b) & 1).astype(np.uint8).reshape(n, d // _GROUP, _GROUP)
        out[b] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Anchors (a, 8 g) -> tables (g, 256, a): the sum of each subset of a group."""
    a, d = anchors.shape
    out = np.zeros((d // _GROUP, 256, a), anchors.dtype)
    for j in range(_GROUP):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + anchors[:, j::_GROUP].T[:, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (n, a) from tables and bit planes, by lookups and shifts."""
    count, groups, n = planes.shape
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    for b in range(count):
        part = tables[0][planes[b, 0]]
        for g in range(1, groups):
            part += tables[g][planes[b, g]]
        part *= 1 << b if b < count - 1 else -(1 << b)
        out += part
    return out


def _type(anchors: np.ndarray, rows: np.ndarray) -> type:
    """A type that holds a hundred times any score of these blocks."""
    top = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    bound = 100 * top(anchors) * (2 * top(rows) + 2) * anchors.shape[1]
    return np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object


def _best(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest of each column, ties to the earlier row."""
    n, a = s.shape
    if s.dtype == object or n <= k:
        at = np.argsort(-s, axis=0, kind="stable")[:k]
    else:
        # Every entry that may be among the k best, then an exact order of these.
        edge = np.partition(s, n - k, axis=0)[n - k]
        row, col = np.nonzero(s >= edge)
        order = np.lexsort((row, -s[row, col].astype(np.int64), col))
        row, col = row[order], col[order]
        start = np.searchsorted(col, np.arange(a))
        keep = np.arange(len(col)) - start[col] < k
        return row[keep], col[keep]
    return at.T.ravel(), np.repeat(np.arange(a), at.shape[0])


def _pairs(anchors: pa.Table, rows: pa.Table, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor numbers, candidate numbers in order of id, scores) for anchors of a
    label and the rows with that label (or the others)."""
    va, vr = (t.column("v").combine_chunks() for t in (anchors, rows))
    width = max(int(np.diff(v.offsets.to_numpy()).max(initial=1)) for v in (va, vr))
    width = max(_GROUP, -(-width // _GROUP) * _GROUP)
    a, r = _matrix(va, width), _matrix(vr, width)
    la, lr = (t.column("label").to_numpy() for t in (anchors, rows))
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    r, lr = r[order], lr[order]
    planes = bit_planes(r)
    a = a.astype(_type(a, r))
    for label in np.unique(la):
        mine = np.flatnonzero((lr == label) == same)
        if not len(mine):
            continue
        own = np.flatnonzero(la == label)
        part = np.ascontiguousarray(planes[:, :, mine])
        for at in range(0, len(own), _AT_ONCE):
            some = own[at : at + _AT_ONCE]
            tables = subset_sums(a[some])
            found = [scores(tables, part[:, :, i : i + _ROWS_AT_ONCE]) for i in range(0, len(mine), _ROWS_AT_ONCE)]
            yield some, order[mine], np.concatenate(found)


_SAME = "a bigint, id bigint, n bigint, score bigint"
_OTHER = "a bigint, positive bigint, id bigint, n bigint, score bigint"


def _table(names: str, columns: list[list[np.ndarray]]) -> pa.Table:
    parts = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]
    return pa.table({n.split()[0]: pa.array(p.astype(np.int64)) for n, p in zip(names.split(", "), parts, strict=True)})


def _same_label(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    out: list[list[np.ndarray]] = [[], [], [], []]
    if anchors.num_rows and rows.num_rows:
        num, own, ids, n = anchors.column("a").to_numpy(), rows.column("a").to_numpy(), rows.column("id").to_numpy(), rows.column("n").to_numpy()
        for some, cand, s in _pairs(anchors, rows, True):
            # One more than asked, as the anchor itself may be among them.
            row, col = _best(s, POSITIVES + 1)
            a, c = num[some[col]], cand[row]
            others = n[c] - (own[c] == a)
            for part, x in zip(out, (a, ids[c], others, s[row, col]), strict=True):
                part.append(x[others > 0])
    return _table(_SAME, out)


def _other_label(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    if anchors.num_rows and rows.num_rows:
        num, ids, n = anchors.column("a").to_numpy(), rows.column("id").to_numpy(), rows.column("n").to_numpy()
        wanted = [sorted(set(p)) for p in anchors.column("scores").to_pylist()]
        for some, cand, s in _pairs(anchors, rows, False):
            for place in range(max(len(wanted[i]) for i in some)):
                col = np.array([c for c, i in enumerate(some) if place < len(wanted[i])])
                goal = np.array([wanted[some[c]][place] for c in col], s.dtype)
                part = s[:, col]
                fits = (LEAST * goal <= 100 * part) & (100 * part <= MOST * goal)
                row, at = np.nonzero(fits)
                order = np.lexsort((row, -part[row, at].astype(np.int64), at))
                row, at = row[order], at[order]
                start = np.searchsorted(at, np.arange(len(col)))
                keep = np.arange(len(at)) - start[at] < NEGATIVES
                row, at = row[keep], at[keep]
                c = cand[row]
                for slot, x in zip(out, (num[some[col[at]]], goal[at], ids[c], n[c], part[row, at]), strict=True):
                    slot.append(x)
    return _table(_OTHER, out)


def _grid(anchors: DataFrame, rows: DataFrame, blocks: int, shards: int, fn, schema: str) -> DataFrame:
    """fn over every pair of an anchor block and a row block, each pair a group."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # New names for the same columns, as both sides come from one table.
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    left = anchors.withColumn("ab", F.pmod(F.xxhash64("a"), F.lit(shards)).cast("int")).withColumn("rb", every(blocks))
    right = rows.withColumn("rb", F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int")).withColumn("ab", every(shards))
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(lambda _, a, b: fn(a, b), schema)


def first_rows(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k first rows of each group by score, then id, counting a row n times;
    ``place`` numbers them from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    few = found.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).drop("__r")
    copies = few.withColumn("n", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))))
    return copies.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("n")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """vectors(id bigint, label, v array<bigint>) -> anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score; ``is_anchor`` is over id."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.where("label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    rows = rows.groupBy("id", F.col("label").cast("bigint").alias("label"), "v").agg(F.count("*").alias("n"))
    # Numbers that stay: they are drawn once, into the written table.
    rows = written(rows.withColumn("a", F.monotonically_increasing_id()).withColumn("q", is_anchor), "vectors")
    total = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks, shards = (max(1, -(-n // size)) for n, size in zip(total, (block_rows, block_anchors), strict=True))
    anchors = rows.where("q").select("a", "label", "v")
    cand = rows.select("a", "id", "label", "v", "n").withColumn("id", F.coalesce("id", F.lit(NO_ID)))

    near = _grid(anchors, cand, blocks, shards, _same_label, _SAME)
    positives = written(first_rows(near, ["a"], POSITIVES), "positives")
    goals = positives.groupBy("a").agg(F.collect_set("score").alias("scores"))
    found = _grid(anchors.join(goals, "a"), cand, blocks, shards, _other_label, _OTHER)
    negatives = first_rows(found, ["a", "positive"], NEGATIVES)

    of = rows.where("q").select("a", F.col("id").alias("anchor_id"), "n")
    pairs = positives.select("a", F.col("id").alias("positive_id"), F.col("score").alias("positive"))
    out = negatives.join(pairs, ["a", "positive"]).join(of, "a").withColumn("n", F.explode(F.sequence(F.lit(1), "n")))
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return out.select(
        "anchor_id",
        known("positive_id"),
        F.col("place").alias("rank"),
        F.nullif("id", F.lit(NO_ID)).alias("negative_id"),
        F.col("positive").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def integer_vectors(table: DataFrame) -> DataFrame:
    """embeddings(vec_id, embedding, label) -> id, label, v with the contract's
    labels and floor(256 x); a vector with a null or non-finite component is null."""
    x = F.transform("embedding", lambda c: F.lit(256) * c.cast("double"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.when(~odd, F.transform(x, lambda c: F.floor(c)))
    return table.select(F.col("vec_id").cast("bigint").alias("id"), label.alias("label"), v.alias("v"))


_ORACLE = f"""WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS row FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.id AS anchor_id, a.row AS anchor, b.id, b.row, a.label = b.label AS same,
          list_dot_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.row <> b.row WHERE a.id % 100 = 0),
      p AS (SELECT anchor_id, anchor, id, row, score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {POSITIVES})
      SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id,
        p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
        AND {LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {MOST} * p.score
      WINDOW w AS (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.id)
      QUALIFY row_number() OVER w <= {NEGATIVES}"""


@register("op12_hard_negatives", _ORACLE)
def q_negatives(spark, sf_dir):
    return hard_negatives(integer_vectors(read_table(spark, sf_dir, "embeddings")), F.col("id") % 100 == 0)
