"""Text scalars.  All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv


def _remove(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def strip_urls(text: Column) -> Column:
    return _remove(text, fv.URL)


def strip_bracket_emoji(text: Column) -> Column:
    """Remove ``[name]`` emoji placeholders."""
    return _remove(text, fv.BRACKET_EMOJI)


def strip_html_tags(text: Column) -> Column:
    return _remove(text, fv.HTML_TAG)


def strip_mentions(text: Column) -> Column:
    return _remove(text, fv.MENTION)


def collapse_whitespace(text: Column) -> Column:
    """Runs of any Unicode space become one blank; blanks at the ends go.

    Two simple passes that leave single blanks, by far the most frequent run, alone are much
    faster than replacing every run.
    """
    return F.trim(F.regexp_replace(F.regexp_replace(text, fv.ODD_SPACE, " "), " {2,}", " "))


def strip_control_chars(text: Column) -> Column:
    return _remove(text, fv.CONTROL_CHARS)


STRIPPERS = (strip_urls, strip_bracket_emoji, strip_html_tags, strip_mentions)
# Text without any of these has nothing to strip.
STRIP_MARKS = ("http", "[", "<", "@")
TIDIERS = (collapse_whitespace, strip_control_chars)


def clean_text(text: Column) -> Column:
    """All cleaners in their fixed order; missing text and the literal ``nan`` become ''.

    Not idempotent: removing one token may join the halves of another.  Apply it once.
    """
    stripped = text
    for strip in STRIPPERS:
        stripped = strip(stripped)
    marked = F.lit(False)
    for mark in STRIP_MARKS:
        marked = marked | F.contains(text, F.lit(mark))
    # Searching for the marks costs far less than four patterns that find nothing.
    cleaned = F.when(marked, stripped).otherwise(F.nullif(text, F.lit("nan")))
    for tidy in TIDIERS:
        cleaned = tidy(cleaned)
    # Not a CASE: functions applied to one are copied into its branches, text cleaning and all.
    return F.coalesce(cleaned, F.lit(""))


def extract_text_from_html(html: Column) -> Column:
    """Visible text: script and style bodies and every tag removed, ends trimmed."""
    body = _remove(html, r"(?s)<(script|style)[^>]*>.*?</\1>")
    text = _remove(body, r"<[^>]+>")
    return F.coalesce(_remove(text, f"^{fv.SPACES}|{fv.SPACES}$"), F.lit(""))


def content_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text).cast("bigint")


def mention_target(text: Column) -> Column:
    """Who a comment answers: the first name after 回复 or @, '' if there is none."""
    return F.regexp_extract(text, fv.MENTION_TARGET, 1)


def normalise_mention(name: Column) -> Column:
    """Drop leading @ signs that ``回复 @name`` leaves in the target."""
    return F.regexp_replace(name, "^@+", "")


def strip_labels(text: Column, labels: Iterable[str]) -> Column:
    """Remove fixed label texts such as a place prefix or a forum suffix."""
    for label in labels:
        text = F.replace(text, F.lit(label), F.lit(""))
    return text


def truncate(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def first_nonempty(*candidates: Column) -> Column:
    """The first value that is neither null nor ''; null if all are."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def content_field(df: DataFrame, names: Iterable[str] = ("content", "comment_text", "text")) -> Column:
    """The first non-empty of the content columns that ``df`` has."""
    present = [F.col(name) for name in names if name in df.columns]
    if not present:
        raise ValueError("no content column present")
    return first_nonempty(*present)


def extract_first_int(text: Column) -> Column:
    """The first run of digits as a number, 0 if there is none."""
    digits = F.nullif(F.regexp_extract(text, "([0-9]+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def to_boolean(text: Column) -> Column:
    """yes/true/t/y/1 and no/false/f/n/0 in any case; null for every other value."""
    word = F.lower(text)
    return F.when(word.isin(fv.TRUE_WORDS), True).when(word.isin(fv.FALSE_WORDS), False)
