"""Text expressions: lower-casing, word splitting, punctuation tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: these must equal the reference's for identical results. ---
# Special tokens and their ids, in insertion order.
PAD_TOKEN, UNK_TOKEN, BOS_TOKEN, EOS_TOKEN = "<PAD>", "<UNK>", "<BOS>", "<EOS>"
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
SPECIAL_TOKENS = [(PAD_TOKEN, PAD_ID), (UNK_TOKEN, UNK_ID), (BOS_TOKEN, BOS_ID), (EOS_TOKEN, EOS_ID)]
# Word pattern: a run of ASCII word characters, or one character that is neither
# a word character nor one of the five ASCII spaces (tab, newline, form feed,
# carriage return, space).  Written out because Java's \s also holds the
# vertical tab and RE2's does not.
TOKEN_PATTERN = "[0-9A-Za-z_]+|[^0-9A-Za-z_\\t\\n\\f\\r ]"
# Punctuation that attaches to the previous word when decoding.
PUNCTUATION = [".", ",", "!", "?", ";", ":"]
# Characters trimmed from both ends of a text: the Unicode white space set.
TRIM_CLASS = "[\\t\\n\\x0B\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
# Characters whose Java lower case depends on context; mapped first so that
# lower-casing is rune by rune.
CONTEXT_FREE_LOWER_FROM = "Σİ"
CONTEXT_FREE_LOWER_TO = "σi"
# --- end of fixed values ---


def lower_runes(c: Column) -> Column:
    """Rune-by-rune lower case (no final-sigma or dotted-I context rules)."""
    for rune, low in zip(CONTEXT_FREE_LOWER_FROM, CONTEXT_FREE_LOWER_TO, strict=True):
        c = F.replace(c, F.lit(rune), F.lit(low))  # a search; translate would visit every rune
    return F.lower(c)


def split_words_expr(c: Column) -> Column:
    """Lower-case, then all matches of the token pattern, as ARRAY<STRING>."""
    return F.regexp_extract_all(lower_runes(c), F.lit(TOKEN_PATTERN), 0)


def is_punctuation_expr(c: Column) -> Column:
    """True for a one-byte token that is one of the punctuation marks."""
    return c.isin(PUNCTUATION)


def normalize_expr(c: Column) -> Column:
    """Paragraph breaks and line breaks become spaces; then trim spaces."""
    text = F.replace(c, F.lit("\n\n"), F.lit(" "))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.regexp_replace(text, F.lit(f"^{TRIM_CLASS}+|{TRIM_CLASS}+$"), F.lit(""))
