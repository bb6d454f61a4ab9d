"""Quality rules with adaptive thresholds.

Every document gets counts (words, symbols, duplicate lines, repeated 8-word
windows) from built-in expressions inside its own row. The ratios of those
counts feed one quantile sketch per (language, source): counts of values in
logarithmic buckets (32 per power of two, so a quantile is off by at most 1/32
of its value). Such sketches merge by adding counts, hence a grouped count with
map-side partial sums builds them, a hot source costs one row per bucket and
task, and the sketch of a language is the sum of those of its sources. Fences
from the quartiles replace fixed cutoffs, and a join brings them back.

Defined cases: a null text has no words and fails the base rules; a null
language or source is a group of its own; groups under ``min_group`` documents
use the sketch of their language, then that of all documents; repeated rows
are judged alike, one result each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import cut_lineage
from .common import WORD, documents, register, row_key

SYMBOLS = "#*$%&|<>"
GRAM = 8


@dataclass(frozen=True)
class Rule:
    """One ratio in thousandths. It fails above the upper fence
    q75 + max(spread * (q75 - q25), slack) and, if ``low``, below the mirrored
    lower one; ``slack`` keeps a group of nearly equal values from rejecting
    its ordinary members."""

    name: str
    value: str
    slack: int
    low: bool = False


RULES = (
    Rule("symbols", "n_symbols * 1000 div n_words", 100),
    Rule("word_length", "word_chars * 1000 div n_words", 3000, low=True),
    Rule("dup_lines", "n_dup_lines * 1000 div n_lines", 400),
    Rule("repeats", "n_repeat_words * 1000 div n_words", 250),
)
SPREAD = 3
MIN_GROUP = 100


def _counts(df: DataFrame) -> DataFrame:
    """df(text, ...) plus the count columns of the contract, in the JVM."""
    text = F.coalesce("text", F.lit(""))
    df = df.withColumns(
        {
            "__w": F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""),
            "__l": F.filter(F.split(text, "\n"), lambda s: s.rlike(WORD)),
        }
    )
    marked = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    df = df.withColumns(
        {
            "n_words": F.size("__w").cast("bigint"),
            "word_chars": F.length(F.array_join("__w", "")).cast("bigint"),
            "n_symbols": F.when(text.rlike(f"[{SYMBOLS}]"), marked).otherwise(0).cast("bigint"),
            "n_lines": F.size("__l").cast("bigint"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint"),
            "__h": F.transform("__w", lambda w: F.xxhash64(w)),
        }
    )
    # Window hashes decide who can have a repeat; the few that can are then
    # compared by the windows' own words. Doubling the width three times takes
    # less than hashing eight words at every start.
    for width in (1, 2, 4):
        after = F.slice("__h", width + 1, 2**31 - 1 - width)
        df = df.withColumn("__h", F.zip_with("__h", after, lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("__h", F.slice("__h", 1, F.greatest(F.size("__h") - (GRAM - 1), F.lit(0))))
    sorted_windows = F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.size("__h") - 1),
                lambda i: F.struct(F.array_join(F.slice("__w", i + 1, GRAM), " ").alias("g"), i.alias("i")),
            )
        ),
    )
    df = df.withColumn("__s", sorted_windows).drop("__h", "__l", "__w")

    def twice(k: Column) -> Column:
        here = F.get("__s", k)
        return F.coalesce(here["g"] == F.get("__s", k - 1)["g"], F.lit(False)) | F.coalesce(
            here["g"] == F.get("__s", k + 1)["g"], F.lit(False)
        )

    at = F.when(
        F.col("__s").isNotNull(),
        F.array_sort(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size("__s") - 1), twice), lambda k: F.get("__s", k)["i"]
            )
        ),
    )
    df = df.withColumn("__p", F.coalesce(at, F.array().cast("array<int>"))).drop("__s")
    gaps = F.transform("__p", lambda p, k: F.least(F.lit(GRAM), F.coalesce(p - F.get("__p", k - 1), F.lit(GRAM))))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)
    df = df.withColumn("n_repeat_words", covered)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return df.drop("__p").withColumn("base_failed", failed)


def bucket(v: Column) -> Column:
    """Logarithmic bucket of a non-negative integer: exact below 64, then 32
    buckets per power of two. Monotone in v."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return shift * 32 + F.call_function("shiftright", v, shift)


def bucket_value(b: Column) -> Column:
    """Smallest value of a bucket."""
    shift = F.greatest(F.floor(b / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (b - shift * 32).cast("bigint"), shift)


def _values(counts: DataFrame) -> DataFrame:
    """counts plus one column per rule, null where the ratio has no base."""
    return counts.withColumns({f"__v_{r.name}": F.expr(f"CASE WHEN n_words > 0 THEN {r.value} END") for r in RULES})


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, rule, b, n): the mergeable sketch of each group."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), bucket(F.col(f"__v_{r.name}")).alias("b")) for r in RULES])
    )
    return (
        _values(counts.where(~F.col("base_failed")))
        .select("lang", "source", pairs.alias("p"))
        .groupBy("lang", "source", F.col("p.rule").alias("rule"), F.col("p.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sk: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each (keys, rule) from merged sketches."""
    merged = sk.groupBy(*keys, "rule", "b").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(*keys, "rule")
    run = merged.withColumns({"cum": F.sum("n").over(part.orderBy("b")), "all": F.sum("n").over(part)})
    at = lambda q: F.min(F.when(F.col("cum") * 4 >= F.col("all") * q, F.col("b")))
    return run.groupBy(*keys, "rule").agg(
        bucket_value(at(1)).alias("q25"), bucket_value(at(3)).alias("q75"), F.max("all").alias("docs")
    )


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, fences map by rule): one row per group of ``counts``."""
    # Every later step has one row per group and bucket.
    sk = cut_lineage(sketches(counts))
    groups = sk.select("lang", "source").distinct()
    levels = [quartiles(sk, k).alias(f"t{i}") for i, k in enumerate((["lang", "source"], ["lang"], []))]
    rules = groups.withColumn("rule", F.explode(F.array(*[F.lit(r.name) for r in RULES])))
    own, lang, every = levels
    joined = (
        rules.alias("g")
        .join(
            own,
            F.col("g.lang").eqNullSafe(F.col("t0.lang"))
            & F.col("g.source").eqNullSafe(F.col("t0.source"))
            & (F.col("g.rule") == F.col("t0.rule")),
            "left",
        )
        .join(lang, F.col("g.lang").eqNullSafe(F.col("t1.lang")) & (F.col("g.rule") == F.col("t1.rule")), "left")
        .join(every, F.col("g.rule") == F.col("t2.rule"), "left")
    )

    def pick(c: str) -> Column:
        return (
            F.when(F.col("t0.docs") >= min_group, F.col(f"t0.{c}"))
            .when(F.col("t1.docs") >= min_group, F.col(f"t1.{c}"))
            .otherwise(F.col(f"t2.{c}"))
        )

    return (
        joined.select("g.lang", "g.source", "g.rule", pick("q25").alias("q25"), pick("q75").alias("q75"))
        .groupBy("lang", "source")
        .agg(
            *[
                F.max(F.when(F.col("rule") == r.name, F.struct("q25", "q75"))).alias(f"__t_{r.name}")
                for r in RULES
            ]
        )
    )


def judge(counts: DataFrame, fences: DataFrame) -> DataFrame:
    """counts plus ``kept``: the base rules, then every fence of the group."""
    ok = F.lit(True)
    for r in RULES:
        q = F.col(f"__f.__t_{r.name}")
        v = F.col(f"__v_{r.name}")
        width = F.greatest((q["q75"] - q["q25"]) * SPREAD, F.lit(r.slack))
        ok = ok & F.coalesce(v <= q["q75"] + width, F.lit(True))
        if r.low:
            ok = ok & F.coalesce(v >= q["q25"] - width, F.lit(True))
    f = fences.select("lang", "source", F.struct(*[f"__t_{r.name}" for r in RULES]).alias("__f"))
    d = _values(counts).alias("d")
    out = d.join(
        f.alias("f"),
        F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source")),
        "left",
    )
    return out.withColumn("kept", ~F.col("base_failed") & ok).select("d.*", "kept").drop(
        *[f"__v_{r.name}" for r in RULES]
    )


def quality_rules(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """docs(doc_id, text, lang, source) -> counts, base_failed and kept per row.

    The counts are small (no text) and frozen once, since both the sketches and
    the verdicts read them."""
    counts = cut_lineage(_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"))
    return judge(counts, thresholds(counts, min_group))


def keep_good(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of docs that pass, with the columns of docs."""
    key = row_key(docs)
    counts = cut_lineage(_counts(docs.select(*key, "lang", "source", "text")).drop("text"))
    kept = judge(counts, thresholds(counts, min_group)).where("kept").select("__wm_d", "__wm_t")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return docs.select(*key, row).join(kept, ["__wm_d", "__wm_t"], "left_semi").select("__row.*")


@register("op7_quality_rules")
def q_quality(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir, "doc_id", "text", "lang", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
