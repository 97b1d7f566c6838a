"""Text functions used by the cleaning rules and the live feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col

# Spellings accepted as "true".
TRUE_WORDS = ("true", "t", "1", "yes", "y")


def trimmed(value: Column | str) -> Column:
    return F.trim(as_col(value).cast("string"))


def trimmed_upper(value: Column | str) -> Column:
    return F.upper(trimmed(value))


def means_true(value: Column | str) -> Column:
    """Two-valued flag from text in any case; NULL and other words are false."""
    return F.coalesce(F.lower(trimmed(value)).isin(*TRUE_WORDS), F.lit(False))


def starts_with(value: Column | str, prefix: str) -> Column:
    return F.startswith(as_col(value).cast("string"), F.lit(prefix))


def captured(value: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, or NULL when the pattern does not match."""
    value = as_col(value)
    return F.when(F.regexp_like(value, F.lit(pattern)), F.regexp_extract(value, pattern, group))


def stripped(value: Column | str, pattern: str) -> Column:
    """Text with every match of the pattern removed, ends trimmed."""
    return F.trim(F.regexp_replace(as_col(value), pattern, ""))


def text_or(value: Column | str, default: str) -> Column:
    """Default for missing or blank text."""
    return F.coalesce(F.nullif(F.trim(as_col(value)), F.lit("")), F.lit(default))


def has_text(value: Column | str) -> Column:
    """True for text that is present and not empty."""
    value = as_col(value)
    return value.isNotNull() & (value != "")


def title_words(value: Column | str) -> Column:
    """Dashes to spaces, words capitalised."""
    return F.initcap(F.replace(as_col(value), F.lit("-"), F.lit(" ")))


def numeric(value: Column | str) -> Column:
    """Text to double, NULL where it is no number."""
    return as_col(value).try_cast("double")


def with_number(value: Column | str, noun: str, number: Column) -> Column:
    """Rewrite ``<digits> <noun>`` in a text with a new count."""
    return F.regexp_replace(as_col(value), F.lit(rf"\d+ {noun}"), F.concat(number.cast("string"), F.lit(f" {noun}")))


def mail_slug(name: Column | str, domain: str) -> Column:
    """Lower-case mail address from a display name."""
    slug = F.lower(as_col(name))
    for old, new in ((" ", "."), ("#", "."), ("'", ""), (",", "")):
        slug = F.replace(slug, F.lit(old), F.lit(new))
    return F.concat(slug, F.lit("@" + domain))
