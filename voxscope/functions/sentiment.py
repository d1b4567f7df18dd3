"""Lexicon sentiment.  A word counts once per listing when it occurs anywhere in the text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def lexicon_hits(text: Column, words: Iterable[str]) -> Column:
    """Sum of the weights of the listed words found in ``text``; null for missing text."""
    weights = Counter(words)
    found = [F.contains(text, F.lit(word)).cast("int") * weight if weight > 1
             else F.contains(text, F.lit(word)).cast("int") for word, weight in weights.items()]
    return reduce(add, found) if found else F.lit(0)


def sentiment_ratio(text: Column, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """(P - N) / (P + N) between -1 and 1; 0 when nothing matches.

    Without a CASE, Spark computes P and N once although both are used twice.
    """
    plus, minus = lexicon_hits(text, positive), lexicon_hits(text, negative)
    return F.coalesce(F.try_divide((plus - minus).cast("double"), (plus + minus).cast("double")), F.lit(0.0))


def sentiment_net(text: Column, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """P - N with every word counted once; 0 for missing text."""
    net = lexicon_hits(text, set_order(positive)) - lexicon_hits(text, set_order(negative))
    return F.coalesce(net.cast("double"), F.lit(0.0))


def searched(text: Column, words: Iterable[str]) -> Column:
    """What to look for the words in: where all are Han, the Han runs of the text, for everything else costs time word by word."""
    return F.regexp_replace(text, r"[^\x{4e00}-\x{9fff}]++", " ") if all(re.fullmatch("[\u4e00-\u9fff]+", w) for w in words) else text


def set_order(words: Iterable[str]) -> list[str]:
    """Distinct words in first-seen order."""
    return list(dict.fromkeys(words))
