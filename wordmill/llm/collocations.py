"""Phrase collocation mining by Toivonen's sampling method.

A phrase is a run of up to ``max_words`` words within one piece of text. It is
frequent if it occurs ``min_count`` times in its language. Every part of a
frequent phrase is frequent, so the search goes as follows.

1. Proposal. A sample of the documents, with the lowered bound ``sample_count``,
   proposes the frequent phrases of each length below ``max_words``.
2. Full pass. All documents are counted, for the proposed phrases and their
   negative border together: the phrases whose two parts without the last and
   without the first word are both proposed. Every single word belongs to it. This
   pass, by far the widest, counts 44-bit hashes of phrases. Two phrases of one
   hash can only be counted too high there, so what it finds infrequent is.
3. Border failures. A phrase of the border that turns out frequent joins the
   proposal, and a further pass counts the phrases that come into reach by it, by
   their texts. That repeats until no border phrase fails; there are at most
   ``max_words`` passes, two at least: the second also counts by their texts the
   phrases that the first found frequent, so all counts that are used are exact.
   The sample decides how much is counted when, never the result.

Proposals travel to the tasks as bitmaps over phrase hashes, one per length, of
a fixed size (``2 ** FILTER_BITS`` bits). A collision lets a phrase be counted
that need not be; it never hides one. On corpora whose proposals fill the
bitmaps, more border phrases are counted and the result stays the same. A phrase
is counted in the first pass whose bitmaps admit it, in that pass alone.

A task counts many documents at a time (SORTED hashes, or a buffer of text)
before Spark sums them, so a hot word costs few rows per task.

Scores: the cut of a phrase into two parts with the least
floor(10^6 a a / (l r)) counts; all arithmetic is on decimals of 38 digits.

Defined cases: a null text is empty; a null lang is ``und``; a lang without a
frequent phrase has no rows; repeated rows count as often as they stand; texts of
any length are worked in buffers that end at piece ends; an empty table gives no
rows; columns but ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import documents, register, written

MIN_COUNT = 10
MAX_WORDS = 3
SAMPLE_ONE_IN = 4  # documents, by the hash of text and row
SAMPLE_COUNT = 2  # lowered bound: a quarter of MIN_COUNT, rounded down
TOP = 2000
FILTER_BITS = 26
BUFFER_BYTES = 4_000_000
SORTED = 9_000_000  # hashes that a task sorts and counts at a time

# A-Z to lower case, tab to space, everything that ends a piece to a full stop.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x2E if c in b".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 9 else c
    for c in range(256)
)
_COUNTS = "lang string, k int, phrase string, c bigint"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def phrase_hash(lang: str, words: list[bytes]) -> int:
    h = _word_hashes(lang, words)
    out = h[:1]
    for i in range(1, len(h)):
        out = _mix(out, h[i : i + 1])
    return int(out[0])


class Filter:
    """A set of phrase hashes as a bitmap of fixed size."""

    def __init__(self, slots: np.ndarray | None = None, masks: np.ndarray | None = None, bits: int = FILTER_BITS):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        if slots is not None:
            self.words[slots] = masks

    def __or__(self, other: Filter) -> Filter:
        out = Filter(bits=self.bits)
        out.words = self.words | other.words
        return out

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _chunks(raw: bytes, size: int) -> Iterator[bytes]:
    at = 0
    while len(raw) - at > size:
        end = raw.rfind(b".", at, at + size)
        if end < 0:
            end = raw.find(b".", at + size)
        if end < 0:
            break
        yield raw[at:end]
        at = end + 1
    yield raw[at:]


def _tokens(raw: bytes) -> tuple[np.ndarray, pa.Array, int]:
    """Word numbers of a folded text, the words they stand for, and the number
    of the mark between pieces."""
    parts = pc.split_pattern(pa.array([b". " + raw.replace(b".", b" . ")], pa.large_binary()), b" ").values
    coded = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, 0


def _scan(
    lang: str, raw: bytes, max_words: int, before: list[Filter] | None, now: list[Filter] | None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """For k = 1 to ``max_words``: k, the hash of the phrase at each place, whether
    it was countable in an earlier pass (``before``; None: there was none) and
    whether it is in this one (``now``; None: every phrase is), word numbers and
    words. A phrase is countable if both its parts are in the filters."""
    ids, words, mark = _tokens(raw)
    one = _word_hashes(lang, words.to_pylist())[ids]
    h = one
    can = ids != mark
    could = can & (before is not None)
    for k in range(1, max_words + 1):
        if k > 1:
            n = len(ids) - k + 1
            if n <= 0:
                return
            inside = can if now is None else can & now[k - 2].has(h)
            can = inside[:n] & inside[1 : n + 1]
            if before is not None:
                inside = could & before[k - 2].has(h)
                could = inside[:n] & inside[1 : n + 1]
            else:
                could = could[:n]
            h = _mix(h[:n], one[k - 1 :])
        yield k, h, could, can, ids, words


def _by_text(h: np.ndarray, at: np.ndarray, k: int, ids: np.ndarray, words: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) of the phrases of k words at places ``at``. Phrases that
    share a hash are told apart by their words."""
    while len(at):
        _, lead, group, counts = np.unique(h[at], return_index=True, return_inverse=True, return_counts=True)
        lead = at[lead]
        other = np.zeros(len(at), bool)
        for j in range(k):
            other |= ids[at + j] != ids[lead[group] + j]
        if other.any():
            counts = np.bincount(group[~other], minlength=len(lead))
        text = words.take(ids[lead])
        for j in range(1, k):
            text = pc.binary_join_element_wise(text, words.take(ids[lead + j]), pa.scalar(b" ", pa.large_binary()))
        yield text, counts
        at = at[other]


# A counted hash has 44 bits, and below them 4 of the phrase's length. Fewer bits
# take less room and let a few more phrases pass as frequent by hash.
LENGTH_BITS, UNUSED_BITS = 4, 16
BUCKET_BITS = 12  # hashes are dealt by so many leading bits


def _pack(h: np.ndarray, c: np.ndarray) -> bytes:
    """Ascending hashes and their counts as compressed bytes: differences and
    counts, byte by byte of all, so that equal leading bytes stand together."""
    short = h >> np.uint64(UNUSED_BITS)
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T) for x in (np.diff(short, prepend=np.uint64(0)), c)]
    return len(h).to_bytes(4, "little") + _ZSTD.compress(b"".join(p.tobytes() for p in planes)).to_pybytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(_ZSTD.decompress(blob[4:], 16 * n), np.uint8).reshape(2, 8, n)
    d, c = (np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in raw)
    return np.cumsum(d, dtype=np.uint64) << np.uint64(UNUSED_BITS), c


_ZSTD = pa.Codec("zstd", 1)


def _add_up(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[start], np.add.reduceat(c, start) if len(h) else c


class _HashCounts:
    """Counts of hashes, SORTED of them at a time, as packed rows by bucket."""

    def __init__(self) -> None:
        self.held = np.empty(SORTED, np.uint64)
        self.size = 0

    def add(self, k: int, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        while at < len(h):
            n = min(len(h) - at, SORTED - self.size)
            part = self.held[self.size : self.size + n]
            np.bitwise_and(h[at : at + n], ~np.uint64((1 << LENGTH_BITS + UNUSED_BITS) - 1), out=part)
            part |= np.uint64(k << UNUSED_BITS)
            self.size, at = self.size + n, at + n
            if self.size == SORTED:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        every = self.held[: self.size]
        self.size = 0
        every.sort()
        new = np.ones(len(every), bool)
        np.not_equal(every[1:], every[:-1], out=new[1:])
        start = np.flatnonzero(new)
        h, c = every[start], np.diff(np.append(start, len(every))).astype(np.uint64)
        bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        edge = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(h)]
        blobs = [_pack(h[a:b], c[a:b]) for a, b in zip(edge, edge[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]]), pa.array(blobs, pa.binary())], names=["b", "z"])


def _buffers(batches: Iterator[pa.RecordBatch], one_in: int, size: int) -> Iterator[tuple[str, bytes]]:
    """(lang, folded text) of many documents at a time, a piece mark between them."""
    held: dict[str, list[bytes]] = {}
    total = 0
    row = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            row += 1
            raw = text.as_py()
            if not raw or (one_in > 1 and xxhash.xxh64_intdigest(raw, row) % one_in):
                continue
            for part in _chunks(raw.translate(_FOLD), size):
                held.setdefault(lang, []).append(part)
                total += len(part)
                if total >= size:
                    yield from ((k, b".".join(v)) for k, v in held.items())
                    held, total = {}, 0
    yield from ((k, b".".join(v)) for k, v in held.items())


def _corpus(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def _filters(marks: DataFrame, longest: int, bits: int) -> list[Filter]:
    """The bitmaps of marks(k, slot, mask) for k = 1 to ``longest``; at most
    2 ** (bits - 6) rows for each k."""
    rows = marks.groupBy("k", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    k, slot, mask = (rows.column(c).to_numpy() for c in ("k", "slot", "mask"))
    return [Filter(slot[k == j], mask[k == j].view(np.uint64), bits) for j in range(1, longest + 1)]


def _marks(bits: int) -> tuple[Column, Column]:
    """Place of the hash column ``h`` in a bitmap: its 64-bit word and the bit."""
    at = F.shiftrightunsigned("h", 64 - bits)
    return F.shiftright(at, 6).cast("int").alias("slot"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("mask")


def _frequent_hashes(docs: DataFrame, max_words: int, one_in: int, now: list[Filter] | None, least: int) -> DataFrame:
    """(h) of the countable phrases of 1 to ``max_words`` words whose hash occurs
    ``least`` times. Counted hashes go to the task of their bucket in packed
    rows; it holds the distinct hashes of one bucket (one in 2 ** BUCKET_BITS of
    all) at a time."""
    sets = docs.sparkSession.sparkContext.broadcast(now)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _HashCounts()
        for lang, raw in _buffers(batches, one_in, BUFFER_BYTES):
            for k, h, _, can, _, _ in _scan(lang, raw, max_words, None, sets.value):
                yield from held.add(k, h[can])
        yield held.flush()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list) -> pa.RecordBatch:
            h, c = _add_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(h[c >= least].view(np.int64))], names=["h"])

        bucket, parts, size = None, [], 0
        for batch in batches:
            for b, z in zip(batch.column("b").to_pylist(), batch.column("z"), strict=True):
                if b != bucket and parts:
                    yield out(parts)
                    parts, size = [], 0
                bucket = b
                parts.append(_unpack(z.as_py()))
                size += len(parts[-1][0])
                if size > SORTED:
                    parts = [_add_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                    size = len(parts[0][0])
        if parts:
            yield out(parts)

    packed = _corpus(docs).mapInArrow(count, "b int, z binary")
    return packed.repartition("b").sortWithinPartitions("b").mapInArrow(add_up, "h bigint")


def _frequent_marks(hashes: DataFrame, bits: int) -> DataFrame:
    k = F.shiftright("h", UNUSED_BITS).bitwiseAND((1 << LENGTH_BITS) - 1)
    return hashes.select(k.alias("k"), *_marks(bits))


def _text_counts(
    docs: DataFrame, before: list[Filter], now: list[Filter], known: list[Filter] | None, max_words: int, min_count: int
) -> DataFrame:
    """(lang, k, phrase, c) from ``min_count`` on, counted by text: the phrases
    countable now and not before, and those of ``known`` that were before. With
    ``known``, rows of k = 0 hold the words of each lang."""
    sets = docs.sparkSession.sparkContext.broadcast((before, now, known))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new, found = sets.value

        def rows(lang: str, k: int, text: pa.Array, c: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(c), pa.string()),
                    pa.array(np.full(len(c), k, np.int32)),
                    text.cast(pa.string()),
                    pa.array(c.astype(np.int64)),
                ],
                names=["lang", "k", "phrase", "c"],
            )

        for lang, raw in _buffers(batches, 1, BUFFER_BYTES):
            for k, h, could, can, ids, words in _scan(lang, raw, max_words, old, new):
                want = can & ~could
                if found is not None:
                    want |= could & found[k - 1].has(h)
                    if k == 1:
                        yield rows(lang, 0, pa.array([b""], pa.large_binary()), np.array([can.sum()]))
                for text, c in _by_text(h, np.flatnonzero(want), k, ids, words):
                    yield rows(lang, k, text, c)

    counts = _corpus(docs).mapInArrow(count, _COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("c").alias("c"))
    return written(counts.where((F.col("c") >= min_count) | (F.col("k") == 0)), "phrases")


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    one_in: int = SAMPLE_ONE_IN,
    sample_count: int = SAMPLE_COUNT,
    bits: int = FILTER_BITS,
) -> tuple[DataFrame, int]:
    """docs(lang, text) -> (lang, k, phrase, c) of every phrase of 1 to
    ``max_words`` (15 at most) words that occurs ``min_count`` times in its lang,
    rows of k = 0 with the words of each lang, and the number of passes over all
    docs."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = _frequent_hashes(docs, max_words - 1, one_in, None, sample_count)
    before = _filters(_frequent_marks(sample, bits), max_words - 1, bits)
    found = _frequent_hashes(docs, max_words, 1, before, min_count)
    known = _filters(_frequent_marks(found, bits), max_words, bits)
    now = [a | b for a, b in zip(before, known, strict=False)]
    out, passes = None, 1
    while True:
        part = _text_counts(docs, before, now, known, max_words, min_count)
        passes += 1
        out = part if out is None else out.unionByName(part)

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = [
                    phrase_hash(lang, phrase.encode().split(b" "))
                    for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), pa.array(np.array(h, np.uint64).view(np.int64))], names=["k", "h"]
                )

        counted = part.where((F.col("k") > 0) & (F.col("k") < max_words)).select("lang", "k", "phrase")
        marks = counted.mapInArrow(places, "k int, h bigint").select("k", *_marks(bits))
        grown = [a | b for a, b in zip(now, _filters(marks, max_words - 1, bits), strict=True)]
        if all((a.words == b.words).all() for a, b in zip(now, grown, strict=True)):
            return out, passes
        before, now, known = now, grown, None


def collocations(docs: DataFrame, top: int | None = TOP, **params) -> DataFrame:
    """docs(lang, text) -> per lang its phrases of two or more words by score:
    lang, rank, phrase, a, l, r, n, score; ``params`` as frequent_phrases."""
    max_words = params.get("max_words", MAX_WORDS)
    found, _ = frequent_phrases(docs, **params)
    sums = found.where("k > 0").select("lang", "phrase", "c")
    words = found.where("k = 0").groupBy("lang").agg(F.sum("c").alias("n"))
    cand = found.where("k > 1").select("lang", "k", "phrase", F.col("c").alias("a"), F.split("phrase", " ").alias("w"))

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    parts = cand.select("lang", "phrase", "a", "k", "w", cut).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, cut + 1, k - cut)"), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        parts = parts.join(sums.select("lang", F.col("phrase").alias(part), F.col("c").alias(name)), ["lang", part])
    score = F.expr(
        "(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))))"
        " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
    )
    best = (
        parts.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("b"))
    )

    # Runs inside a longer candidate, with the longer one's greatest count.
    inner = cand.where(F.col("k") > 2).select(
        "lang",
        "a",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(w, s, m), ' '))))"
            )
        ).alias("phrase"),
    )
    over = inner.groupBy("lang", "phrase").agg(F.max("a").alias("over")) if max_words > 2 else None
    kept = best
    if over is not None:
        kept = best.join(over, ["lang", "phrase"], "left").where("over IS NULL OR 100 * over < 50 * a").drop("over")
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "b.l", "b.r", "n", "b.score"
    )


_ORACLE = f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
      p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM d),
      g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS c FROM (
          SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 4) AS r(k)) GROUP BY ALL),
      n AS (SELECT lang, sum(c)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
      f AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE c >= {MIN_COUNT}),
      s AS (SELECT x.lang, x.phrase, x.c AS a, y.c AS l, z.c AS r, cut,
          ((1000000::HUGEINT * x.c * x.c) // (y.c::HUGEINT * z.c))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) x
        JOIN f y ON y.lang = x.lang AND y.phrase = array_to_string(x.w[1:cut], ' ')
        JOIN f z ON z.lang = x.lang AND z.phrase = array_to_string(x.w[cut + 1:], ' ')),
      b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
      o AS (SELECT lang, phrase, max(c) AS over FROM (SELECT lang, c, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase
        FROM f WHERE k = 3) GROUP BY ALL),
      q AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
        FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE over IS NULL OR 100 * over < 50 * a)
      SELECT lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= {TOP}"""


@register("op11_phrase_collocations", _ORACLE)
def q_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir, "lang", "text"))
