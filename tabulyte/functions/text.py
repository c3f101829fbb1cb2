"""Text expressions: plain column functions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns of links, handles and emoji code points.
LINKS = r"http\S+|www\.\S+"
HANDLES = r"@\w+"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]"
)


def words(c: str | Column) -> Column:
    """Whitespace-separated tokens."""
    text = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def word_count(c: str) -> Column:
    return F.size(words(c)).cast("bigint")


def has(c: str, pattern: str, literal: bool = False) -> Column:
    """Whether the text holds a pattern; null text counts as no."""
    hit = F.contains(F.col(c), F.lit(pattern)) if literal else F.col(c).rlike(pattern)
    return F.coalesce(hit, F.lit(False))


def starts_with(c: str, prefix: str) -> Column:
    return F.coalesce(F.startswith(F.col(c), F.lit(prefix)), F.lit(False))


def has_emoji(c: str) -> Column:
    return has(c, EMOJI)


def caps_ratio(c: str) -> Column:
    """Upper-case letters per character; 0 for empty text."""
    upper = F.length(F.regexp_replace(c, r"\P{Lu}+", ""))
    return upper / F.greatest(F.length(c), F.lit(1))


def _stripped(c: str | Column) -> Column:
    low = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    # a plain search is far cheaper than a pattern, and few texts hold either
    linked = F.contains(low, F.lit("http")) | F.contains(low, F.lit("www."))
    bare = F.when(linked, F.regexp_replace(low, LINKS, "")).otherwise(low)
    return F.when(F.contains(low, F.lit("@")), F.regexp_replace(bare, HANDLES, "")).otherwise(bare)


def letters_only(c: str | Column) -> Column:
    """Lower case; links and handles removed; other non-letters become spaces."""
    return F.regexp_replace(_stripped(c), r"[^a-z\s]", " ")


def clean_spaced(c: str | Column) -> Column:
    """As `letters_only`, with runs of white space squeezed to one blank."""
    return F.trim(F.regexp_replace(_stripped(c), r"[^a-z]+", " "))


def letter_words(c: str | Column) -> Column:
    """The runs of letters in `letters_only`; an empty string may stand at either end."""
    return F.split(_stripped(c), r"[^a-z]+")


def clean_deleted(c: str | Column) -> Column:
    """As `clean_spaced`, but non-letters are deleted."""
    letters = F.regexp_replace(_stripped(c), r"[^a-z\s]", "")
    return F.trim(F.regexp_replace(letters, r"\s+", " "))


def last_part(c: str, sep: str) -> Column:
    return F.trim(F.element_at(F.split(F.col(c), sep), -1))


def first_digit(c: str) -> Column:
    """Leading character of a number's text if it is a digit."""
    head = F.substring(F.col(c).cast("string"), 1, 1)
    return F.when(head.rlike("^[0-9]$"), head)


def stars(p: str | Column) -> Column:
    """Significance marks of a p-value."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c < 0.001, "***").when(c < 0.01, "**").when(c < 0.05, "*").otherwise("ns")


def feature_block(c: str) -> list[Column]:
    """The numeric text features that a model reads, in one projection."""
    return [
        F.length(c).cast("bigint").alias("text_len"), word_count(c).alias("word_count"),
        has(c, "http", literal=True).cast("bigint").alias("has_url"),
        has(c, "?", literal=True).cast("bigint").alias("has_question"),
        has(c, "!", literal=True).cast("bigint").alias("has_exclaim"),
        has_emoji(c).cast("bigint").alias("has_emoji"),
        starts_with(c, "@").cast("bigint").alias("has_mention"),
        caps_ratio(c).alias("caps_ratio"),
    ]
