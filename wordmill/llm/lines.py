"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that hold a word, each by the hash of
its trimmed text. A window is ``run`` lines, or fewer lines that hold ``words``
or more words in all (a single line or a whole short document included). Every
window selects its least hash (the last one of equals) as fingerprint, so two
equal runs of ``run`` or more lines, or of ``words`` or more words, always select
a fingerprint at the same place. Then:

1. Fingerprints are counted by length of window; one that was selected at a single place cannot
   belong to a repeated run, and its windows go.
2. The windows left are joined with the first place (by doc_id, then position)
   that has the same fingerprint and the same lines around it. Matching the whole
   window decides the extension to both sides of the fingerprint within it;
   neighbouring windows that match extend the run further, both ways. A matched
   window that lies in a longer matched one adds nothing and goes.
3. Every run that also stands at an earlier place is deleted.

Joining to the first place instead of all places gives no pairs: a passage in a
third of all documents costs one row per occurrence. Counts and first places are
summed map-side; the joins have a unique right side, so hot keys can be split.
All repeats are judged on the input.

Defined cases: a null text stays null and has no lines; blank lines are no items
(those inside a deleted run go with it); a document of fewer than ``run`` lines and
``words`` words is never touched; rows equal in every column count as one document and share its result;
an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, register, row_key

RUN = 3
WORDS = 50  # so many words make a window of fewer lines; None: only runs of RUN lines
_BLANK = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_items(docs: DataFrame) -> DataFrame:
    """docs(__wm_d, __wm_t, text) -> per document, the hashes ``h`` of its lines
    and their words ``c``."""
    items = F.filter(F.transform(_lines(F.col("text")), lambda s: F.regexp_replace(s, _BLANK, "")), lambda s: s != "")
    count = lambda s: F.regexp_count(s, F.lit(r"[\x20\x09-\x0D]+")) + 1
    pairs = F.transform(items, lambda s: F.struct(F.xxhash64(s).alias("h"), count(s).alias("c")))
    df = docs.select("__wm_d", "__wm_t", pairs.alias("i")).where(F.size("i") > 0)
    return df.select("__wm_d", "__wm_t", F.col("i.h").alias("h"), F.col("i.c").alias("c"))


def windows(items: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """line_items() -> one row per window: its start, its lines ``k``, the
    selected fingerprint ``f``, whether an earlier window of as many lines
    selected the same place (``again``), and two hashes of the window's lines."""

    def of_length(k: int) -> Column:
        def window(s: Column) -> Column:
            part = F.slice("h", s + 1, k)
            least = F.array_min(part)
            place = s + k - F.array_position(F.reverse(part), least).cast("int")
            return F.struct(
                s.alias("s"),
                F.lit(k).alias("k"),
                least.alias("f"),
                place.alias("p"),
                F.xxhash64(part).alias("x"),
                F.xxhash64(F.lit("second"), part).alias("y"),
            )

        starts = F.when(F.size("h") >= k, F.sequence(F.lit(0), F.size("h") - k)).otherwise(F.array().cast("array<int>"))
        if k < run:
            held = lambda s: F.aggregate(F.slice("c", s + 1, k), F.lit(0), lambda a, n: a + n)
            starts = F.filter(starts, lambda s: held(s) >= words)
        return F.transform(starts, window)

    lengths = [run] if words is None else range(1, run + 1)
    df = items.withColumn("w", F.concat(*[of_length(k) for k in lengths])).drop("h", "c")
    before = lambda i: F.get("w", i - 1)
    flagged = F.transform(
        "w",
        lambda w, i: w.withField(
            "again", F.coalesce((before(i)["p"] == w["p"]) & (before(i)["k"] == w["k"]), F.lit(False))
        ).dropFields("p"),
    )
    return df.select("__wm_d", "__wm_t", F.explode(flagged).alias("w")).select("__wm_d", "__wm_t", "w.*")


def repeated_runs(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """docs(__wm_d, __wm_t, text) -> __wm_d, __wm_t, runs: array<struct<a,b>>
    of item numbers [a, b) to delete, and n_matches: the matched runs, each
    with one earlier place."""
    w = windows(cut_lineage(line_items(docs).distinct()), run, words)
    shared = (
        w.groupBy("k", "f").agg(F.count(F.when(~F.col("again"), 1)).alias("places")).where("places > 1").select("k", "f")
    )
    seeds = w.join(shared, ["k", "f"]).select("k", "f", "x", "y", F.struct("__wm_d", "__wm_t", "s").alias("at"))
    same = ["k", "f", "x", "y"]
    first = seeds.groupBy(*same).agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = seeds.join(first, same).where("at <> first").select("at.*", "k", (F.col("at.s") + F.col("k")).alias("e"), "first")
    # Per document: matches at the same distance to one earlier document grow
    # into one run; overlapping runs are deleted together.
    doc = Window.partitionBy("__wm_d", "__wm_t").orderBy("s", F.col("k").desc())
    reach = F.max("e").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("reach", reach).where("reach IS NULL OR reach < e")
    prev = F.lag(F.struct("s", "k", "first")).over(doc)
    follows = (
        (prev["s"] + 1 == F.col("s"))
        & (prev["k"] == F.col("k"))
        & (prev["first"]["__wm_d"] == F.col("first.__wm_d"))
        & (prev["first"]["__wm_t"] == F.col("first.__wm_t"))
        & (prev["first"]["s"] + 1 == F.col("first.s"))
    )
    step = later.withColumns(
        {
            "new_match": F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1),
            "new_run": F.when(F.coalesce(F.col("s") <= F.lag("e").over(doc), F.lit(False)), 0).otherwise(1),
        }
    ).withColumn("r", F.sum("new_run").over(doc))
    runs = step.groupBy("__wm_d", "__wm_t", "r").agg(
        F.min("s").alias("a"), F.max("e").alias("b"), F.sum("new_match").alias("m")
    )
    return runs.groupBy("__wm_d", "__wm_t").agg(
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs"), F.sum("m").alias("n_matches")
    )


def dedup_lines(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """All columns of docs in ``__row``, with the new text ``kept``, n_lines
    (items), n_removed (items deleted) and n_matches."""
    key = row_key(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    found = repeated_runs(docs.select(*key, "text"), run, words)
    df = docs.select(*key, row).join(found, ["__wm_d", "__wm_t"], "left")
    df = df.withColumn("__l", _lines(F.col("__row.text")))
    items = F.filter(
        F.transform("__l", lambda s, i: F.when(s.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull()
    )
    df = df.withColumn("__at", items).withColumn(
        "__cut",
        F.transform("runs", lambda r: F.struct(F.get("__at", r["a"]).alias("a"), F.get("__at", r["b"] - 1).alias("b"))),
    )
    # The lines between the cuts, which are in order and apart: no line looks at all cuts.
    cut = lambda r, side, end: F.coalesce(F.get(F.col("__cut"), r)[side], end)
    after = lambda r: F.when(r == 0, F.lit(0)).otherwise(cut(r - 1, "b", F.lit(0)) + 1)
    gap = lambda r: F.slice("__l", after(r) + 1, cut(r, "a", F.size("__l")) - after(r))
    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("__cut")), gap)), "\n")
    removed = F.aggregate(F.coalesce("runs", F.array()), F.lit(0).cast("bigint"), lambda a, r: a + r["b"] - r["a"])
    return df.select(
        "__row",
        F.when(F.col("runs").isNull(), F.col("__row.text")).otherwise(kept).alias("kept"),
        F.size("__at").cast("bigint").alias("n_lines"),
        F.when(F.col("runs").isNull(), 0).otherwise(removed).cast("bigint").alias("n_removed"),
        F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
    )


def without_repeats(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """docs with repeated runs of lines deleted from the texts. A document all
    of whose lines were deleted goes."""
    out = dedup_lines(docs, run, words).where("n_removed = 0 OR n_removed < n_lines")
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"__row.`{c}`") for c in docs.columns])


_ORACLE = f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
      it AS (SELECT doc_id, i, regexp_replace(line, '{_BLANK}', '', 'g') AS t,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
      a AS (SELECT doc_id, list(t ORDER BY j) AS t, list(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) ORDER BY j) AS c
        FROM it GROUP BY doc_id),
      w AS (SELECT doc_id, j, k, t[j:j + k - 1] AS g FROM (
          SELECT doc_id, t, c, k, unnest(range(1, len(t) - k + 2)) AS j FROM a, range(1, {RUN + 1}) AS r(k))
        WHERE k = {RUN} OR list_sum(c[j:j + k - 1]) >= {WORDS}),
      f AS (SELECT doc_id, j, k, min((doc_id, j)) OVER (PARTITION BY k, g) AS first FROM w),
      x AS (SELECT doc_id, j, k, first[1] AS d1, first[2] AS j1, max(j + k) OVER (PARTITION BY doc_id ORDER BY j, k DESC
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f WHERE first <> (doc_id, j)),
      y AS (SELECT * FROM x WHERE reach IS NULL OR reach < j + k),
      gone AS (SELECT DISTINCT doc_id, unnest(range(j, j + k)) AS j FROM y),
      m AS (SELECT doc_id, count(*) AS n_matches FROM (SELECT *, lag((j + 1, k, d1, j1 + 1)) OVER (
          PARTITION BY doc_id ORDER BY j, k DESC) AS prev FROM y)
        WHERE prev IS NULL OR prev <> (j, k, d1, j1) GROUP BY doc_id),
      cut AS (SELECT it.doc_id, it.i, it.j - row_number() OVER (PARTITION BY it.doc_id ORDER BY it.j) AS island
        FROM it JOIN gone USING (doc_id, j)),
      span AS (SELECT doc_id, min(i) AS a, max(i) AS b, count(*) AS c FROM cut GROUP BY doc_id, island),
      k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY i) AS kept FROM l
        WHERE NOT EXISTS (SELECT 1 FROM span s WHERE s.doc_id = l.doc_id AND l.i BETWEEN s.a AND s.b) GROUP BY l.doc_id)
      SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(s.c, 0)::BIGINT AS n_removed,
        coalesce(m.n_matches, 0) AS n_matches,
        sha256(CASE WHEN s.c IS NULL THEN coalesce(d.text, '') ELSE coalesce(k.kept, '') END) AS kept_sha256
      FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM it GROUP BY 1) n USING (doc_id)
        LEFT JOIN (SELECT doc_id, sum(c) AS c FROM span GROUP BY 1) s USING (doc_id)
        LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)"""


@register("op1_line_dedup", _ORACLE)
def q_lines(spark, sf_dir):
    return dedup_lines(documents(spark, sf_dir, "doc_id", "text")).select(
        "__row.doc_id",
        "n_lines",
        "n_removed",
        "n_matches",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
