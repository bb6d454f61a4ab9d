"""Corpus preparation: strip structure from web pages and wiki text, cap the
number of articles, count lines/words, and audit leftover structure.

Everything is a chain of regex and array expressions: one narrow stage, no
shuffle except the ORDER BY ... LIMIT of ``limit_articles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: cleaning rules (our reading of the published rule list). ---
HTML_DROP_BLOCKS = [
    "(?is)<script\\b.*?</script\\s*>",
    "(?is)<style\\b.*?</style\\s*>",
    "(?is)<nav\\b.*?</nav\\s*>",
    "(?s)<!--.*?-->",
    "(?is)<ref[^>]*/>",
    "(?is)<ref[^>]*>.*?</ref\\s*>",
]
HTML_BREAKS = "(?i)</(p|div|h[1-6]|li|ul|ol|tr|table|article|section|header|footer|title|blockquote|pre)\\s*>|<br\\s*/?>"
HTML_TAG = "(?s)<[^>]*>"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
WIKI_DROP = ["(?is)<ref[^>]*/>", "(?is)<ref[^>]*>.*?</ref\\s*>", "(?s)\\{\\{.*?\\}\\}"]
WIKI_LINK_LABEL = ("\\[\\[[^\\]|]*\\|([^\\]]*)\\]\\]", 1)
WIKI_LINK = ("\\[\\[([^\\]]*)\\]\\]", 1)
LINE_DROP = "^(\\||\\*|\\{\\||!|==|See also|Main article|Coordinates|Category:)"
LINE_TRIM = "^[ \\t\\r\\f]+|[ \\t\\r\\f]+$"
PAGE_DROP_REDIRECT = "(?i)^[ \\t\\r\\n\\f]*#redirect"
PAGE_DROP_MARKERS = ["(disambiguation)", "may refer to:"]
TABLE_LINE = "^\\|.*\\|"
HEADER_LINE = "^=="
STRUCTURE_WARN_ABOVE = 5
MIN_LINES = 5
# --- end of fixed values ---


def strip_html(c: Column) -> Column:
    for pat in HTML_DROP_BLOCKS:
        c = F.regexp_replace(c, F.lit(pat), F.lit(""))
    c = F.regexp_replace(c, F.lit(HTML_BREAKS), F.lit("\n"))
    c = F.regexp_replace(c, F.lit(HTML_TAG), F.lit(""))
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def strip_wiki(c: Column) -> Column:
    for pat in WIKI_DROP:
        c = F.regexp_replace(c, F.lit(pat), F.lit(""))
    for pat, grp in (WIKI_LINK_LABEL, WIKI_LINK):
        c = F.regexp_replace(c, F.lit(pat), F.lit(f"${grp}"))
    return c


def keep_prose_lines(c: Column) -> Column:
    lines = F.transform(F.split(c, "\n"), lambda l: F.regexp_replace(l, F.lit(LINE_TRIM), F.lit("")))
    kept = F.filter(lines, lambda l: (l != F.lit("")) & ~l.rlike(LINE_DROP))
    return F.array_join(kept, "\n")


def is_redirect_or_disambiguation(c: Column) -> Column:
    cond = c.rlike(PAGE_DROP_REDIRECT)
    for marker in PAGE_DROP_MARKERS:
        cond = cond | F.contains(c, F.lit(marker))
    return cond


def clean_articles(df: DataFrame, text: str = "text", html: bool = True, out: str = "text") -> DataFrame:
    """Keep prose: HTML and wiki markup out, structural lines out, redirect
    and disambiguation pages out, empty pages out."""
    raw = F.col(text)
    body = strip_html(raw) if html else raw
    body = strip_wiki(body)
    cleaned = df.withColumn("_body", body)
    kept = cleaned.where(~is_redirect_or_disambiguation(F.col("_body")))
    kept = kept.withColumn(out, keep_prose_lines(F.col("_body"))).drop("_body")
    if out != text and text in kept.columns:
        kept = kept.drop(text)
    return kept.where(F.col(out) != "")


def limit_articles(df: DataFrame, n: int = 1000, key: str = "doc_id") -> DataFrame:
    """The first n articles by key (a top-n: TakeOrderedAndProject)."""
    return df.orderBy(key).limit(n)


def corpus_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Lines (as in wc -l of the texts written one after another, each ending
    in a newline), whitespace words (wc -w), tokens with BOS/EOS, and the
    minimum-size check."""
    from ..functions.text import split_words_expr

    c = F.col(text)
    lines = F.size(F.split(c, "\n"))
    words = F.size(F.regexp_extract_all(c, F.lit("[^\\t\\n\\x0B\\f\\r ]+"), 0))
    toks = F.size(split_words_expr(c)) + 2
    agg = df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.coalesce(F.sum(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.sum(words), F.lit(0)).cast("bigint").alias("n_words"),
        F.coalesce(F.sum(toks), F.lit(0)).cast("bigint").alias("n_tokens"),
    )
    return agg.withColumn("big_enough", F.col("n_lines") >= MIN_LINES)


def structural_audit(df: DataFrame, text: str = "text") -> DataFrame:
    """Leftover table lines and header lines; warn above 5 of either."""
    lines = df.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
    agg = lines.agg(
        F.coalesce(F.sum(F.col("line").rlike(TABLE_LINE).cast("int")), F.lit(0)).cast("bigint").alias("table_lines"),
        F.coalesce(F.sum(F.col("line").rlike(HEADER_LINE).cast("int")), F.lit(0)).cast("bigint").alias("header_lines"),
    )
    return agg.withColumn(
        "warn", (F.col("table_lines") > STRUCTURE_WARN_ABOVE) | (F.col("header_lines") > STRUCTURE_WARN_ABOVE)
    )
