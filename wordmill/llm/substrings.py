"""Exact dedup of byte strings over suffix arrays built by Lyndon groups.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
is removed. A suffix array of the whole corpus would pass through one machine, so
the strings are first routed to where their equals are:

1. Anchors. Each string (window) of LENGTH bytes selects its least GRAM-byte hash
   (the last of equals). Equal windows select it at the same offset, and each
   window has one anchor; about one position in 85 is an anchor. Anchors whose
   hash occurs once have no repeated window.
2. The windows that select one anchor form its context, 368 bytes at most.
   Contexts with the same bytes are counted map-side: those that occur twice
   are repeated as a whole. This settles exact copies of any number.
3. The distinct contexts of an anchor hash that are left (around edits, and where
   a shared passage ends) meet in one task, at most GROUP per hash. Windows
   are cut into cells of CELL offsets; those of a cell share the bytes between, its
   core. Cores that occur once are settled, as are cells with equal bytes. For the
   rest, each context gives the text ``left bytes, core as one symbol, right bytes``,
   and a suffix array over these texts (Lyndon groups, see gsaca.py) sorts
   the windows: equal windows are neighbours that share CELL symbols.
4. An anchor hash with over GROUP distinct contexts takes an exact way without a
   large group: its windows are hashed and counted one by one, with partial sums.

Matches never cross documents, and a document may repeat itself. Strings are judged
on the input. Hashes have 64 bits beside the anchor's, so equality is not checked
byte by byte in steps 2 and 4.

Defined cases: a null text is empty; texts under LENGTH bytes are kept; rows equal
in every column are separate occurrences, so long ones lose all their bytes; an
empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .common import documents, map_text, register, row_key, written
from .gsaca import suffix_array

LENGTH = 200
GRAM = 32
CELL = 16
GROUP = 20_000
HOT_SHARE = 1000  # a class with more than one row in so many is hot
SEGMENT = 1 << 20  # windows of a text that are hashed at a time
SYMBOLS = 100_000  # of one suffix array

_PLACE = np.uint64(0xFFFFFF)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def anchors(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, place, least and greatest offset place - start) of the anchors of
    the windows of ``text``, a segment at a time. Greatest offset first start."""
    for base in range(0, len(text) - length + 1, SEGMENT):
        part = text[base : base + SEGMENT + length - 1]
        n = len(part) - GRAM + 1
        x = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))
        h = x[:n] * _ODD[0]
        for k in (1, 2, 3):
            h ^= h >> np.uint64(29)
            h += x[8 * k : 8 * k + n] * _ODD[k]
        h ^= h >> np.uint64(32)
        h *= _ODD[0]
        h ^= h >> np.uint64(29)
        # Least hash first, then the last place.
        best = (h & ~_PLACE) | (_PLACE - np.arange(n, dtype=np.uint64))
        width, size = length - GRAM + 1, 1
        while size * 2 <= width:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        if size < width:
            best = np.minimum(best[: size - width], best[width - size :])
        place = (_PLACE - (best & _PLACE)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        last = np.concatenate((first[1:], [len(place)])) - 1
        p = place[first]
        yield h[p].view(np.int64), p + base, p - last, p - first


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """docs(__wm_d, __wm_t, text) -> h, a (least offset * 65536 + greatest),
    hull (hash of the context), d, t, p."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t = (batch.column(c).to_numpy() for c in ("__wm_d", "__wm_t"))
            parts: list[list[np.ndarray]] = []
            rows = 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_buffer()
                text = text.to_pybytes() if text is not None else b""
                for h, p, lo, hi in anchors(text, length):
                    hull = np.fromiter(
                        map(xxhash.xxh3_64_intdigest, map(text.__getitem__, map(slice, (p - hi).tolist(), (p - lo + length).tolist()))),
                        np.uint64,
                        len(p),
                    ).view(np.int64)
                    parts.append([h, lo * 65536 + hi, hull, np.full(len(p), d[i]), np.full(len(p), t[i]), p])
                    rows += len(p)
                if rows > 200_000:
                    yield _rows(parts)
                    parts, rows = [], 0
            if parts:
                yield _rows(parts)

    def _rows(parts):
        h, a, hull, d, t, p = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(a.astype(np.int32)), pa.array(hull), pa.array(d), pa.array(t), pa.array(p)],
            names=["h", "a", "hull", "d", "t", "p"],
        )

    return (
        docs.where(F.octet_length("text") >= length)
        .select("__wm_d", "__wm_t", F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "h bigint, a int, hull bigint, d bigint, t bigint, p bigint")
    )


def _contexts(docs: DataFrame, todo: DataFrame, length: int) -> DataFrame:
    """todo(h, a, c, d, t, p) with ``ctx``, the bytes of each context."""
    need = todo.groupBy("d", "t").agg(F.collect_list(F.struct("h", "a", "c", "p")).alias("need"))
    rows = docs.join(need, (F.col("__wm_d") == F.col("d")) & (F.col("__wm_t") == F.col("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                need = batch.column("need")
                size = np.diff(need.offsets.to_numpy())
                flat = need.flatten()
                h, a, c, p = (flat.field(k) for k in range(4))
                doc = np.repeat(np.arange(batch.num_rows), size)
                lo, hi = np.divmod(a.to_numpy(), 65536)
                texts = batch.column("text").to_pylist()
                start = p.to_numpy() - hi
                end = p.to_numpy() - lo + length
                ctx = [texts[i][s:e] for i, s, e in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)]
                d, t = (batch.column(k).take(pa.array(doc)) for k in ("d", "t"))
                yield pa.RecordBatch.from_arrays([h, a, c, d, t, p, pa.array(ctx, pa.binary())], names=names)

    names = ["h", "a", "c", "d", "t", "p", "ctx"]
    return rows.select("d", "t", F.col("text").cast("binary").alias("text"), "need").mapInArrow(
        run, "h bigint, a int, c bigint, d bigint, t bigint, p bigint, ctx binary"
    )


class Resolver:
    """Collects contexts that share an anchor hash and finds their repeated
    windows; ``done`` gets (d, t, start, end) of runs of them."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.text: list[int] = []
        self.cores = 0
        #: start in the text, greatest and least offset, rows it speaks for
        self.texts: list[tuple[int, int, int, list[tuple]]] = []
        self.done: list[tuple[int, int, int, int]] = []

    def add(self, rows: list[tuple[int, int, int, int, int, bytes]]) -> None:
        """rows: (copies, d, t, p, a, ctx); one that stands for several
        copies is settled and only there to be compared with."""
        cells: dict[tuple[int, bytes], list[tuple]] = {}
        for row in rows:
            lo, hi = divmod(row[4], 65536)
            ctx = row[5]
            for q in range(lo // CELL, hi // CELL + 1):
                a1, a2 = q * CELL, q * CELL + CELL - 1
                core = ctx[hi - a1 : hi + self.length - a2]
                cells.setdefault((q, core), []).append((max(lo, a1), min(hi, a2), row))
        for (q, _), found in cells.items():
            if len(found) < 2:
                continue
            same: dict[tuple[int, int, bytes], list[tuple]] = {}
            for lo, hi, row in found:
                top = row[4] % 65536
                same.setdefault((lo, hi, row[5][top - hi : top - lo + self.length]), []).append(row)
            alone = False
            for (lo, hi, _), equal in same.items():
                if sum(r[0] for r in equal) > 1:
                    self.done += [(r[1], r[2], r[3] - hi, r[3] - lo + self.length) for r in equal if r[0] == 1]
                else:
                    alone = True
            if alone and len(same) > 1:
                self.cores += 1
                self._write(q, same)
        if len(self.text) > SYMBOLS:
            self.flush()

    def _write(self, q: int, same: dict[tuple[int, int, bytes], list[tuple]]) -> None:
        a1, a2 = q * CELL, q * CELL + CELL - 1
        for (lo, hi, hull), rows in same.items():
            self.texts.append((len(self.text), hi, lo, rows if sum(r[0] for r in rows) == 1 else []))
            # Symbols: 0 ends all, 1 ends a text, then bytes, then cores.
            self.text += [b + 2 for b in hull[: hi - a1]]
            self.text.append(257 + self.cores)
            self.text += [b + 2 for b in hull[len(hull) - (a2 - lo) :]] if a2 > lo else []
            self.text.append(1)

    def flush(self) -> None:
        """Suffix-sorts the texts so far: a window is repeated if a neighbour
        shares its CELL symbols."""
        text = [*self.text, 0]
        again = bytearray(len(text))
        if self.texts:
            order = suffix_array(text)
            window = bytearray(len(text))
            for at, hi, lo, _ in self.texts:
                window[at : at + hi - lo + 1] = b"\1" * (hi - lo + 1)
            last, last_part = -1, None
            for i in order:
                if not window[i]:
                    continue
                part = text[i : i + CELL]
                if part == last_part:
                    again[i] = again[last] = 1
                last, last_part = i, part
        for at, hi, lo, rows in self.texts:
            for _, d, t, p, *_ in rows:
                first = None
                for k in range(hi - lo + 2):
                    hit = k <= hi - lo and again[at + k]
                    if hit and first is None:
                        first = k
                    elif not hit and first is not None:
                        # Offsets fall as starts grow: start k has offset hi - k.
                        self.done.append((d, t, p - hi + first, p - hi + k - 1 + self.length))
                        first = None
        self.text, self.texts, self.cores = [], [], 0


def _resolve(contexts: DataFrame, length: int) -> DataFrame:
    """contexts -> d, t, s, e of repeated runs, one group of an anchor hash
    after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, key, rows = Resolver(length), None, []

        def out() -> pa.RecordBatch:
            cols = np.array(work.done, np.int64).reshape(-1, 4).T
            work.done = []
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["d", "t", "s", "e"])

        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                cols = [batch.column(c).to_pylist() for c in ("c", "d", "t", "p", "a", "ctx")]
                for h, *row in zip(batch.column("h").to_pylist(), *cols, strict=True):
                    if h != key:
                        if len(rows) > 1:
                            work.add(rows)
                        key, rows = h, []
                    rows.append(tuple(row))
                if work.done:
                    yield out()
        if len(rows) > 1:
            work.add(rows)
        work.flush()
        if work.done:
            yield out()

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, "d bigint, t bigint, s bigint, e bigint")


def _count_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchor hashes with very many contexts: every window is
    hashed and counted."""
    lo, hi = F.floor(F.col("a") / 65536).cast("int"), (F.col("a") % 65536).cast("int")
    one = contexts.select("*", hi.alias("hi"), F.explode(F.sequence(lo, hi)).alias("o"))
    one = one.select(
        "h", "c", "d", "t", "o", (F.col("p") - F.col("o")).alias("s"),
        F.xxhash64(F.substring("ctx", F.col("hi") - F.col("o") + 1, F.lit(length))).alias("x"),
    )
    twice = one.groupBy("h", "o", "x").agg(F.sum("c").alias("n")).where("n > 1").drop("n")
    return one.where("c = 1").join(twice, ["h", "o", "x"]).select("d", "t", "s", (F.col("s") + length).alias("e"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """docs(__wm_d, __wm_t, text) -> d, t, spans: byte ranges [s, e) that lie in
    repeated strings (they may overlap), for rows that have any."""
    found = _anchor_rows(docs, length)
    # Written first, so that the join can split the rows of a hot hash.
    heads = written(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "heads")
    shared = written(found.join(heads, "h"), "anchors")
    # Written as well: the join that marks all copies of a class can then be
    # split, which it can't be above a grouped side.
    classes = written(
        shared.groupBy("h", "a", "hull").agg(F.count("*").alias("c"), F.min(F.struct("d", "t", "p")).alias("one")),
        "classes",
    )
    mixed = classes.groupBy("h").agg(F.count("*").alias("m"), F.min("c").alias("least")).where("m > 1 AND least = 1")
    todo = cut_lineage(
        classes.join(mixed.select("h", "m"), "h").select("h", "a", "c", "m", "one.d", "one.t", "one.p")
    )
    lo, hi = F.floor(F.col("a") / 65536), F.col("a") % 65536
    # Classes with more than one row in HOT_SHARE of all are fewer than that. Their
    # rows are dealt over the parts of the shuffle, and each part gets the class.
    same, parts = ["h", "a", "hull"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col("c") > max((classes.agg(F.sum("c")).first()[0] or 0) // HOT_SHARE, 1)
    of_hot = F.col("hull").isin([r.hull for r in classes.where(hot).select("hull").distinct().collect()])
    marks = classes.where("c > 1").select(
        *same, F.explode(F.when(of_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))).alias("part")
    )
    # Not by a hash of the row: equal rows would stay together.
    part = F.when(of_hot, F.floor(F.rand(0) * parts).cast("int")).otherwise(0)
    copies = shared.withColumn("part", part).join(marks, [*same, "part"])
    whole = copies.select("d", "t", (F.col("p") - hi).alias("s"), (F.col("p") - lo + length).alias("e"))
    rest = _resolve(_contexts(docs, todo.where(F.col("m") <= group), length), length)
    many = todo.where(F.col("m") > group)
    if not many.isEmpty():
        rest = rest.unionByName(_count_windows(_contexts(docs, many, length), length))
    spans = whole.unionByName(rest)
    return spans.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def dedup_substrings(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """docs(doc_id, text, ...) -> its columns in ``__row``, n_bytes, spans (the
    merged byte ranges removed) and kept (the bytes left)."""
    key = row_key(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    # A null text is an empty one.
    keyed = docs.select(*key, F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(keyed, length, group)
    rows = docs.select(*key, row, F.coalesce("text", F.lit("")).alias("text")).join(
        spans, (F.col("__wm_d") == F.col("d")) & (F.col("__wm_t") == F.col("t")), "left"
    )

    def cut(texts: list[bytes], batch: pa.RecordBatch) -> dict[str, pa.Array]:
        merged, kept = [], []
        column = batch.column("spans")
        for text, i in zip(texts, range(batch.num_rows), strict=True):
            own = []
            if column[i].is_valid:
                flat = column[i].values
                s, e = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order])
                new = np.concatenate(([True], s[1:] > e[:-1]))
                ends = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))
                own = list(zip(s[new].tolist(), e[ends].tolist(), strict=True))
            last, left = 0, []
            for a, b in own:
                left.append(text[last:a])
                last = b
            left.append(text[last:])
            merged.append([{"s": a, "e": b} for a, b in own])
            kept.append(b"".join(left))
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        return {
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "removed": pa.array(merged, kind),
            "kept": pa.array(kept, pa.binary()),
        }

    return map_text(
        rows.select("__row", "text", "spans"),
        cut,
        "n_bytes bigint, removed array<struct<s:bigint,e:bigint>>, kept binary",
        drop=("text", "spans"),
        with_batch=True,
    )


@register("op3_suffix_array_dedup")
def q_substrings(spark, sf_dir):
    cut = dedup_substrings(documents(spark, sf_dir, "doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, x: a + x["e"] - x["s"])
    return cut.select(
        "__row.doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
