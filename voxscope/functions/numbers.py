"""Numeric, conditional and lookup scalars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv

_NUMERIC = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"


def to_number(value: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    The guard matters: a bare cast also accepts ``12d`` and ``1f``.
    """
    text = value.cast("string")
    return F.when(text.rlike(_NUMERIC), F.trim(text).try_cast("double"))


def parse_cn_count(value: Column) -> Column:
    """Like :func:`to_number`, and ``1.2万`` / ``3亿`` are understood."""
    text = value.cast("string")
    scale = (F.when(text.endswith("万"), F.lit(1e4)).when(text.endswith("亿"), F.lit(1e8))
             .otherwise(F.lit(1.0)))
    return to_number(F.regexp_replace(text, "[万亿]$", "")) * scale


def activity_score(comments: Column, likes: Column, replies: Column) -> Column:
    return comments * F.lit(1.0) + likes * F.lit(0.1) + replies * F.lit(0.5)


def interaction_count(likes: Column, replies: Column) -> Column:
    return likes + replies


def has_picture(pictures: Column) -> Column:
    return F.coalesce(F.length(pictures) > 10, F.lit(False))


def is_reply(parent_id: Column, numeric_only: bool = False) -> Column:
    """True for a comment with a parent; ids are compared as text, since many are hex.

    ``numeric_only`` first turns the id into a number, so that hex ids count as no parent.
    """
    if numeric_only:
        return F.coalesce(to_number(parent_id) != 0, F.lit(False))
    text = F.trim(parent_id.cast("string"))
    return F.coalesce(~text.isin("", "0", "0.0"), F.lit(False))


def sentiment_label(score: Column, margin: float = 0.1) -> Column:
    labels = fv.SENTIMENT_LABELS
    return (F.when(score > margin, labels["positive"]).when(score < -margin, labels["negative"])
            .otherwise(labels["neutral"]))


def training_label(score: Column) -> Column:
    return F.when(score > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def sentiment_density(score: Column, length: Column) -> Column:
    """Score per hundred characters; null for empty text."""
    return F.when(length > 0, score / length * 100)


def bin_right_closed(value: Column, bins: Sequence[tuple[float, float, str]] = fv.LENGTH_GROUPS) -> Column:
    """Label of the interval ``(lower, upper]`` holding the value; null outside all of them."""
    label = F.lit(None).cast("string")
    for lower, upper, name in reversed(bins):
        label = F.when((value > lower) & (value <= upper), name).otherwise(label)
    return label


def code_label(code: Column, labels: Mapping[str, str], default: str | None) -> Column:
    """Look a code up in a small fixed table."""
    label = F.lit(default)
    for key, name in labels.items():
        label = F.when(code == key, name).otherwise(label)
    return F.when(code.isNull(), F.lit(default)).otherwise(label)


def gender_label(platform: Column, code: Column) -> Column:
    """Gender by platform; the same code means different things on different platforms."""
    result = F.lit(None).cast("string")
    for name, (labels, default) in fv.GENDER_CODES.items():
        result = F.when(platform == name, code_label(code.cast("string"), labels, default)).otherwise(result)
    return result


def node_display_size(rank: Column, scale: float = 80000.0) -> Column:
    return rank * F.lit(scale)
