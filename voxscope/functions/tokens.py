"""Tokens from native expressions: phrases, Latin runs, and bigrams of Han runs.

There is no word segmenter in Spark.  Han text is cut into overlapping bigrams, the usual
dictionary-free choice; a segmenter of your own plugs in through ``segmenter``.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# 0-9 A-Z a-z and U+00C0 to U+024F.  Characters below 256 are listed one by one: a lookup is faster than four ranges.
LATIN = "[" + string.digits + string.ascii_letters + "".join(rf"\x{{{i:x}}}" for i in range(0xC0, 0x100)) + r"\x{100}-\x{24f}]"
HAN = r"[\x{4e00}-\x{9fff}]"


def tokenize(text: Column, min_len: int = 2, phrases: Iterable[str] = (),
             segmenter: Callable[[Column], Column] | None = None) -> Column:
    """Array of tokens of at least ``min_len`` characters, in text order, repeats kept."""
    if segmenter is not None:
        tokens = F.filter(segmenter(text), lambda t: F.length(t) >= min_len)
    else:
        kept = sorted({p for p in phrases if len(p) >= min_len}, key=lambda p: (-len(p), p))
        escaped = [re.escape(p) for p in kept]
        # A Han run ends where a phrase begins, so that phrases are found inside running text.
        han = f"(?:(?!{'|'.join(escaped)}){HAN})" if kept else HAN
        choices = [*escaped, f"{LATIN}{{{min_len},}}+", f"{han}{{{min_len},}}+"]
        runs = F.regexp_extract_all(text, F.lit("(" + "|".join(choices) + ")"), F.lit(1))
        # Only text with a longer Han run needs cutting; everything else is tokens already.
        cut = F.flatten(F.transform(runs, lambda run: _split_run(run, kept)))
        tokens = F.when(text.rlike(f"{HAN}{{3,}}"), cut).otherwise(runs)
    return F.coalesce(tokens, F.array().cast("array<string>"))


def _split_run(run: Column, phrases: list[str]) -> Column:
    whole = F.array(run)
    is_han = run.rlike(f"^{HAN}") & (F.length(run) > 2)
    if phrases:
        is_han = is_han & ~run.isin(phrases)
    bigrams = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
    return F.when(is_han, bigrams).otherwise(whole)


def drop_stop_words(tokens: Column, stop_words: Iterable[str], drop_numbers: bool = True) -> Column:
    """Remove stop words and, by default, tokens of digits only; repeats of the rest stay."""
    stops = list(stop_words)

    def keep(token: Column) -> Column:
        ok = ~token.isin(stops) if stops else F.lit(True)
        return ok & ~token.rlike("^[0-9]+$") if drop_numbers else ok

    return F.filter(tokens, keep)


def phrase_group(token: Column, groups: dict[str, str]) -> Column:
    """The group a custom phrase belongs to; null for every other token."""
    group = F.lit(None).cast("string")
    for phrase, name in groups.items():
        group = F.when(token == phrase, name).otherwise(group)
    return group
